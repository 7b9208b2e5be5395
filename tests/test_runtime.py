import os

from boxlake.runtime import cleanup, discard, work_folder, written


def test_written(spark):
    df = written(spark.range(5).selectExpr("id", "id * 2 as b"), "numbers")
    path = df._boxlake_path
    assert path.startswith(work_folder(spark)) and os.path.isdir(path) and df.count() == 5 and df.columns == ["id", "b"]
    discard(df)
    assert not os.path.exists(path)
    discard(spark.range(1))
    other = written(spark.range(1).toDF("x"), "other")._boxlake_path
    cleanup(spark)
    assert not os.path.exists(other)


def test_work_folder_is_the_sessions(spark):
    folder = work_folder(spark)
    assert folder == work_folder(spark) and os.path.isdir(folder.removeprefix("file:").replace("//", "/"))
