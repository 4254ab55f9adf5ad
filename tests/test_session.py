from pathlib import Path
from types import SimpleNamespace

import pytest

from estrato import session


def _session(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder if folder else default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_named_folder_is_used():
    assert session.shared_folder(_session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["yarn", "local[2]"])
def test_no_folder_is_made_up(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(_session(master))


def test_an_application_can_choose_its_folder():
    spark = _session("k8s")
    session.use_shared_folder(spark, "s3a://bucket/scratch/")
    assert session.shared_folder(spark) == "s3a://bucket/scratch"


def test_staged_tables_can_be_dropped(spark):
    folder = session.new_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    session.drop_staged(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_staged_tables_keep_rows_and_schema(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS DOUBLE) AS b, 'x' AS c")
    staged = session.stage(df, "test")
    assert staged.dtypes == df.dtypes
    assert staged.collect() == df.collect()
    assert "Project" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_the_package_ships_once_with_fixed_bytes(spark, tmp_path):
    package = Path(session.__file__).resolve().parent
    first = session._package_archive(package)
    assert first == session._package_archive(package)
    session.ship_package(spark)
    spark.range(3).write.parquet(str(tmp_path / "numbers"))
    for _ in range(2):
        session.drop_staged(spark)
        session.ship_package(spark)
        found = spark.range(4).mapInPandas(lambda frames: (f.assign(id=f.id * 2) for f in frames), "id long")
        assert sorted(r.id for r in found.collect()) == [0, 2, 4, 6]
        assert spark.read.parquet(str(tmp_path / "numbers")).count() == 3
