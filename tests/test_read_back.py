"""Read-back of a table with a folder for each row: folders listed by few tasks, and read once."""

import uuid

from lakemart.plans import contract as C
from lakemart.session import scratch_dir
from lakemart.sources.schemas import IMMIGRATION_SCHEMA
from lakemart.sources.sinks import default_writers, read_back, write_table

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _rows(n):
    return [(m, f"a{i}", {"F": i + 1}, float(i), 30.0, {"Business": 1}, {}, {i: 2}, {"XX": i + 1, "YY": 1}, m * n + i)
            for m in (1, 2) for i in range(n)]


def _stored(spark, n):
    path = scratch_dir(spark, "listed")
    write_table(spark.createDataFrame(_rows(n), IMMIGRATION_SCHEMA), path, C.KEYS, writers=default_writers(spark))
    return path


def test_folders_are_listed_by_few_tasks(spark):
    n, sc, group = 40, spark.sparkContext, uuid.uuid4().hex  # beyond 32 folders Spark lists by a job
    path, before = _stored(spark, n), spark.conf.get(LISTING)
    sc.setJobGroup(group, "read-back")
    try:
        back = read_back(spark, path, IMMIGRATION_SCHEMA, C.KEYS)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = [s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds]
    tasks = [status.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= default_writers(spark)
    assert spark.conf.get(LISTING) == before
    assert sorted(map(tuple, back.collect()), key=lambda r: r[-1]) == _rows(n)


def test_maps_read_the_folders_once(spark):
    n = 3
    long = C._maps_long(read_back(spark, _stored(spark, n), IMMIGRATION_SCHEMA, C.KEYS))
    assert not [f for f in long.inputFiles() if "airport_cd=" in f]  # they were read, and are not read again
    names = {"gender": 2, "trip_purpose": 5, "visa_type": 6, "countries": 7, "airlines": 8}
    expected = [(r[0], r[1], m, str(k), v) for r in _rows(n) for m, at in names.items() for k, v in r[at].items()]
    expected.append((None, None, "ids", None, 2 * n))
    assert sorted(map(tuple, long.collect()), key=repr) == sorted(expected, key=repr)
