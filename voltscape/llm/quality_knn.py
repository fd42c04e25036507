"""Quality classifier: similarity-weighted votes of labelled neighbours in a latent space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from voltscape.llm.common import map_rows

#: Labelled documents that are fitted on, at most: those with the smallest hash of doc_id.
FIT_ROWS = 6_000
#: Byte trigrams are hashed into this many terms.
TRIGRAMS = 4096
#: Terms for how repetitive a text is: ten steps each for different words and repeated neighbours.
STEPS = 10
TERMS = TRIGRAMS + 2 * STEPS
#: Weight of a repetition term beside the trigrams, whose weights have length 1.
REPETITION = 0.7
LATENT = 48
NEIGHBOURS = 15
#: A neighbour's vote weighs its cosine to this power.
SHARPNESS = 8
#: Documents whose products are computed at a time.
BLOCK = 1024
CUT = 0.7


def term_counts(text: bytes) -> np.ndarray:
    """Hashed byte trigrams of a whole text (ends are padded), and its repetition terms."""
    found = np.zeros(TERMS, np.float32)
    data = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint32)
    if not text.strip():
        return found
    mixed = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D))
    found[:TRIGRAMS] = np.bincount(mixed >> np.uint32(20), minlength=TRIGRAMS)
    words = text.split()
    different = len(set(words)) / len(words)
    again = sum(map(eq, words, words[1:])) / len(words)
    found[TRIGRAMS + min(STEPS - 1, int(different * STEPS))] = 1
    found[TRIGRAMS + STEPS + min(STEPS - 1, int(again * STEPS))] = 1
    return found


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of damped tf-idf weights of length 1, and the repetition terms; empty texts are 0."""
    weights = np.log1p(counts)
    weights[:, :TRIGRAMS] *= idf
    length = np.linalg.norm(weights[:, :TRIGRAMS], axis=1, keepdims=True)
    weights[:, :TRIGRAMS] /= np.where(length > 0, length, 1)
    weights[:, TRIGRAMS:] = REPETITION * (counts[:, TRIGRAMS:] > 0)
    return weights


@dataclass
class Model:
    """What is broadcast: bounded by FIT_ROWS x LATENT and TERMS x LATENT numbers."""

    idf: np.ndarray
    basis: np.ndarray  # terms x latent
    vectors: np.ndarray  # labelled documents x latent, length 1
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        found = _weighted(counts, self.idf) @ self.basis
        length = np.linalg.norm(found, axis=1, keepdims=True)
        return found / np.where(length > 0, length, 1)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of the votes of the nearest labelled vectors for label 1; without any similar
        vector, as for an empty text, 0."""
        if not len(self.vectors):
            return np.zeros(len(counts))
        cosine = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = nearest(cosine, k)
        votes = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1).astype(float) ** SHARPNESS
        total = votes.sum(axis=1)
        return np.where(total > 0, (votes * self.labels[near]).sum(axis=1) / np.where(total > 0, total, 1), 0.0)


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest values of each row, in column order; of equal ones the first."""
    least = np.partition(cosine, -k, axis=1)[:, -k, None]
    above, equal = cosine > least, cosine == least
    room = k - above.sum(axis=1, keepdims=True)
    taken = above | (equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= room))
    return np.nonzero(taken)[1].reshape(len(cosine), k)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """ln((1 + N) / (1 + n)) of every trigram term, over all documents."""

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        total = np.zeros(TERMS, np.int64)
        for text in batch["text"]:
            total += term_counts(text) > 0
        return {"total": [[*total.tolist(), len(batch["text"])]]}

    parts = map_rows(docs.selectExpr("cast(coalesce(text, '') as binary) as text"), "total array<long>", kernel)
    sums = parts.selectExpr("posexplode(total) as (term, n)").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS + 1)
    counts[[r.term for r in sums]] = [r.n for r in sums]
    return np.log((1 + counts[-1]) / (1 + counts[:TRIGRAMS])).astype(np.float32)


def fit(docs: DataFrame, labelled: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Latent-semantic model: truncated SVD of the weighted terms of at most `rows` labelled
    documents (doc_id, text, label), those with the smallest hash of doc_id, in that order; of several
    texts of one doc_id the one with the smallest hash. The inverse document frequencies count all of `docs`. Only term counts of the fitted documents reach the driver."""
    chosen = labelled.where("label is not null").selectExpr("doc_id", "xxhash64(doc_id) as h", "cast(label as int) as label").distinct()
    chosen = chosen.orderBy("h", "doc_id", "label").limit(rows)
    texts = docs.join(F.broadcast(chosen), "doc_id").selectExpr(
        "h", "label", "xxhash64(text) as th", "cast(coalesce(text, '') as binary) as text"
    )

    def kernel(batch: dict[str, list]) -> dict[str, list]:
        counts = [term_counts(text) for text in batch["text"]]
        spots = [np.flatnonzero(c) for c in counts]
        return {
            "h": batch["h"],
            "label": batch["label"],
            "th": batch["th"],
            "term": [s.astype(np.int16).tolist() for s in spots],
            "n": [c[s].tolist() for c, s in zip(counts, spots)],
        }

    found = map_rows(texts, "h long, label int, th long, term array<short>, n array<float>", kernel)
    # one row for each of the chosen, so no more than `rows`
    one = found.groupBy("h", "label").agg(F.expr("min_by(struct(term, n), th) as _s")).selectExpr("h", "label", "_s.*")
    table = one.orderBy("h", "label").toArrow()
    counts = np.zeros((table.num_rows, TERMS), np.float32)
    if table.num_rows:
        terms, n = (table[c].combine_chunks() for c in ("term", "n"))
        row = np.repeat(np.arange(table.num_rows), np.diff(terms.offsets.to_numpy()))
        counts[row, terms.flatten().to_numpy()] = n.flatten().to_numpy()
    labels = np.array(table["label"].to_pylist(), float)
    idf = inverse_frequencies(docs)
    weights = _weighted(counts, idf)
    basis = _basis(weights)
    model = Model(idf, basis, np.zeros((0, basis.shape[1]), np.float32), labels)
    model.vectors = model.latent(counts).astype(np.float32)
    return model


def _basis(weights: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration."""
    random = np.random.default_rng(0)
    found = random.standard_normal((TERMS, LATENT), dtype=np.float32)
    for _ in range(rounds):
        found, _ = np.linalg.qr(weights.T @ (weights @ found))
    return np.ascontiguousarray(found, np.float32)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of `docs` (doc_id, text, any more).

    The labelled vectors are broadcast; the cosines of every document with all of them are
    computed exactly, in blocks of BLOCK documents, and the labels of the nearest are weighed by
    similarity. Whole texts are used, whatever their length. NULL and empty texts, and texts
    without a word, score 0. Repeated rows come out repeated with equal scores; an empty table
    gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = StructType.fromDDL(f"doc_id {kind}, score double")
    arrow = to_arrow_schema(wanted)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                counts = np.stack([term_counts(text) for text in part["text"].to_pylist()])
                scores = np.clip(shared.value.scores(counts), 0, 1)
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(scores)], schema=arrow)

    return docs.selectExpr("doc_id", "cast(coalesce(text, '') as binary) as text").mapInArrow(score, wanted)


def predictions(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) with labels from `labels` (doc_id, quality), learnt
    only where crc32(doc_id as text) % 4 is not 2. Of several labels of a document all count."""
    held = "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2"
    known = labels.where(f"doc_id is not null and not ({held})").selectExpr("doc_id", "quality as label")
    found = scored(docs, fit(docs, known))
    return found.selectExpr(
        "doc_id", f"coalesce({held}, false) as held_out", "score", f"if(score >= {cut}, 1, 0) as predicted"
    )
