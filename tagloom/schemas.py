"""Schemas of every frame that crosses a storage boundary."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns.items()])


# Column names, order and types of the stored tables.
POSTS = _table(
    id="int",
    AcceptedAnswerId="int",
    AnswerCount="int",
    Body="string",
    CommentCount="int",
    CreationDate="date",
    FavoriteCount="int",
    LastEditDate="date",
    LastEditorDisplayName="string",
    LastEditorUserId="int",
    OwnerUserId="int",
    ParentId="int",
    PostTypeId="int",
    Score="float",
    Tags="string",
    Title="string",
    ViewCount="int",
)

POST_TYPES = _table(Id="int", Type="string")

USERS = _table(
    id="int",
    Age="int",
    CreationDate="date",
    DisplayName="string",
    DownVotes="int",
    EmailHash="string",
    Location="string",
    Reputation="int",
    UpVotes="int",
    Views="int",
    WebsiteUrl="string",
    AccountId="int",
)

LABELED_QUESTIONS = _table(
    question_id="int",
    Text="string",
    prediction="int",
    decoded="string",
    AcceptedAnswerId="int",
    AnswerCount="int",
    CommentCount="int",
    CreationDate="timestamp",
    FavoriteCount="int",
    LastEditDate="timestamp",
    LastEditorUserId="int",
    OwnerUserId="int",
    PostTypeId="int",
    Score="float",
    Tags="strings",
    Title="string",
    ViewCount="int",
    Type="string",
    batch_datetime_stamp="timestamp",
    load="string",
)

USERS_DIM = _table(
    id="int",
    CreationDate="date",
    Year="int",
    Month="int",
    DisplayName="string",
    DownVotes="int",
    Location="string",
    Reputation="int",
    UpVotes="int",
    Views="int",
    AccountId="int",
    processing_datetime_stamp="timestamp",
)

#: Counts of a published load, from which the reports are made.
TOPIC_COUNTS = _table(
    day="date",
    topic="string",
    Type="string",
    OwnerUserId="int",
    questions="long",
    sum_AnswerCount="double",
    sum_CommentCount="double",
    sum_FavoriteCount="double",
    sum_Score="double",
    sum_ViewCount="double",
    n_AnswerCount="long",
    n_CommentCount="long",
    n_FavoriteCount="long",
    n_Score="long",
    n_ViewCount="long",
    batch_datetime_stamp="timestamp",
    load="string",
)

#: Sketches of the distinct values of a published load.
TOPIC_SKETCHES = _table(day="date", topic="string", questions="binary", owners="binary", batch_datetime_stamp="timestamp", load="string")
