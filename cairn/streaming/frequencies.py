"""Document frequencies of tokens, kept under changes of the documents.

A base and signed deltas (``DeltaAggregate``): a batch of changed documents adds
its tokens' differences, so new documents are summarised against all others
without reading them again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cairn.operators import changes as ch
from cairn.operators import text as tx
from cairn.streaming.deltas import DeltaAggregate


@dataclass(frozen=True)
class TokenFrequencies:
    root: str
    text_col: str = "text"

    @property
    def state(self) -> DeltaAggregate:
        return DeltaAggregate(self.root, ("tok",), (), "df")

    def start(self, docs: DataFrame) -> None:
        """Frequencies of the documents there are."""
        self.state.start(tx.token_rows(docs.select(self.text_col), self.text_col))

    def add(self, feed: DataFrame, batch_id: int, share: float = 0.5) -> bool:
        """Count a change feed of documents, once however often its batch is
        replayed; False where the base already holds it. The deltas are folded
        into the base when they outgrow a share of it."""
        rows = tx.token_rows(feed.select(self.text_col, ch.ACTION), self.text_col)
        added = self.state.add(rows, batch_id)
        self.state.compact(feed.sparkSession, share)
        return added

    def read(self, spark: SparkSession) -> DataFrame:
        """(tok, df) of the documents now."""
        return self.state.read(spark)
