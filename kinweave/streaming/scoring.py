"""Scoring a stream of new vendor records with a trained model: an extension, the batch engine does not need it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kinweave.operators import features, preprocess, retrieval
from kinweave.operators.model import MatchModel
from kinweave.sources.tables import write_stage


def score_batch(records: DataFrame, s1: DataFrame, model: MatchModel, top_k: int = 30, dimensions: int = 384) -> DataFrame:
    """Predictions for the new records of one micro-batch against the static, preprocessed S1; retrieval and encoder are the batch stage's."""
    new = preprocess.preprocess(records)
    corpus = s1.select("entity_id", "search_text").unionByName(new.select("entity_id", "search_text"))
    postings = retrieval.tfidf(corpus)
    ids = lambda df: df.select(df["entity_id"].alias("id")).distinct()
    found = retrieval.tfidf_topk(postings.join(ids(s1), "id", "left_semi"), postings.join(ids(new), "id", "left_semi"), top_k)
    encode = retrieval.hashed_encoder(dimensions)
    vectors = lambda df: df.select(df["entity_id"].alias("id"), encode(df["search_text"]).alias("vector"))
    pairs = retrieval.merge_candidates(found, retrieval.dense_topk(vectors(s1), vectors(new), top_k))
    return model.predict(features.pair_features(pairs, s1, new, new.where("false")))


def score_stream(stream: DataFrame, s1: DataFrame, model: MatchModel, out: str, checkpoint: str, top_k: int = 30, dimensions: int = 384) -> StreamingQuery:
    """Writes each micro-batch's predictions under its own number, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        write_stage(score_batch(batch, s1, model, top_k, dimensions), f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
