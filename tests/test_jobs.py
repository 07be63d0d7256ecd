"""The command line, from source folders to published tables."""

from __future__ import annotations

from tagloom import jobs
from tagloom.catalog import views


def test_all_jobs_in_order(spark, small, tmp_path, capsys):
    lake, source = str(tmp_path / "lake"), tmp_path / "source"
    views.posts(spark, small).write.parquet(str(source / "posts" / "day"))
    views.post_types(spark).write.parquet(str(source / "types"))
    views.users(spark, small).write.parquet(str(source / "users"))

    def run(*args):
        jobs.main(["--root", lake, "--database", "jobs_test", *args])

    run("ingest-posts", "--source", str(source / "posts"), "--load", "2023_10_22")
    run("ingest-dimension", "--name", "post_types", "--parquet", str(source / "types"))
    run("ingest-dimension", "--name", "users", "--parquet", str(source / "users"))
    run("train", "--max-iterations", "3")
    run("tag", "--load", "2023_10_22", "--batch", "2023_10_22_02")
    run("publish-users", "--batch", "2023_10_22_02")
    run("summarize", "--batch", "2023_10_22_02", "--load", "2023_10_22")
    run("report", "--name", "totals", "--summaries")

    printed = capsys.readouterr().out
    assert "weighted_f1" in printed and "batch 2023_10_22_02" in printed
    assert spark.table("jobs_test.labeled_questions").count() == 73
    assert spark.table("jobs_test.users_dim").count() == 150
