"""Loads that are tagged and published as their files arrive."""

from tagloom.streaming.tagging import publish_arrivals, tag_arrivals

__all__ = ["publish_arrivals", "tag_arrivals"]
