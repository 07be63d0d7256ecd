"""Where things are stored and how a model is trained."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Zones:
    """Storage roots, database and table format of one deployment."""

    landing: str
    training: str
    intermediate: str
    model: str
    label_index: str
    serving: str
    database: str = "topics"
    table_format: str = "parquet"

    @classmethod
    def under(cls, root: str, **overrides: str) -> "Zones":
        root = root.rstrip("/")
        folders = {
            "landing": f"{root}/landing",
            "training": f"{root}/training",
            "intermediate": f"{root}/training/steps",
            "model": f"{root}/model",
            "label_index": f"{root}/label_index",
            "serving": f"{root}/serving",
        }
        return cls(**{**folders, **overrides})

    @property
    def posts(self) -> str:
        return f"{self.landing}/posts"

    @property
    def post_types(self) -> str:
        return f"{self.landing}/post_types"

    @property
    def users(self) -> str:
        return f"{self.landing}/users"

    @property
    def labeled_questions(self) -> str:
        return f"{self.database}.labeled_questions"

    @property
    def users_dim(self) -> str:
        return f"{self.database}.users_dim"


@dataclass(frozen=True)
class TrainingSettings:
    """Model parameters; the defaults are the published settings."""

    # Vocabulary size, minimum document frequency, iterations and train share.
    vocabulary: int = 65536
    min_doc_freq: int = 5
    max_iterations: int = 100
    train_share: int = 90

    vectorizer: str = "count"
    aggregation_depth: int = 2
    #: Refuse a fit whose coefficients need more bytes on the driver; off unless set.
    coefficient_limit_bytes: int | None = None
    #: Partitions of the training rows; unless set, the cores, or those of the input if more.
    partitions: int | None = None
