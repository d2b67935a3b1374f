"""Feature vectors and train/test splits."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import schemas as S
from gaugeflow import session


def assemble(flat: DataFrame, handle_invalid: str = "skip") -> DataFrame:
    """Put the 18 features into one vector, in fixed order, and drop them.

    With `skip` a row with a missing feature is left out; with `error` it ends
    the job. Decoded messages have such rows set aside before.
    """
    assembler = VectorAssembler(
        inputCols=S.FEATURES, outputCol="features", handleInvalid=handle_invalid
    )
    return assembler.transform(flat).drop(*S.FEATURES)


def random_split(rows: DataFrame, seed: int = 42, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """About 80 and 20 of 100 rows; which ones depends on the layout of the rows.

    Rows are drawn once and written with their part, so the parts are read apart, need no order
    to be the same whenever they are read, and hold every row once between them.
    """
    drawn = F.when(F.rand(seed) < train_share, "train").otherwise("test")
    staged = session.stage(rows.withColumn("_part", drawn), "split", "_part")
    train, test = (staged.where(F.col("_part") == part).drop("_part") for part in ("train", "test"))
    return train, test


def split_part(identity: Column, seed: int = 42, train_percent: int = 80) -> Column:
    """`train` or `test` by a hash of the identity, the same in every layout.

    Give something that differs between rows, such as the place in the topic.
    Rows of equal identity go to the same part.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), identity.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.when(number % 100 < train_percent, "train").otherwise("test")
