"""The jobs: landing, training, tagging and the users dimension."""

from tagloom.plans.ingest import ingest_dimension, ingest_posts
from tagloom.plans.report import report, summarize_load, summary_report
from tagloom.plans.tag import tag_load
from tagloom.plans.train import train
from tagloom.plans.users import publish_users

__all__ = ["ingest_dimension", "ingest_posts", "publish_users", "report", "summarize_load", "summary_report", "tag_load", "train"]
