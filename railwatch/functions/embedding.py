"""Evidence text to unit vectors, in Arrow batches.

The hash embedding is deterministic and needs no model.  The ONNX embedding loads its model
once per Python worker and checks the files against their manifest first.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.settings import CampaignSettings

VECTOR = T.ArrayType(T.FloatType())

# Words that count as one concept.
CONCEPTS = {
    "override": ("ignore", "disregard", "bypass"),
    "previous": ("earlier", "prior", "previous"),
    "reveal": ("reveal", "show", "disclose"),
    "prompt": ("prompt", "message"),
    "instructions": ("instructions", "rules"),
}
_CONCEPT_OF = {word: concept for concept, words in CONCEPTS.items() for word in words}
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")  # ASCII blanks only, as the contract says


def _utf16(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-16-le", "surrogatepass"), dtype="<u2")


def string_hash(word: str) -> int:
    """Polynomial base-31 hash over UTF-16 units, wrapped to a signed 32-bit integer."""
    value = 0
    for unit in _utf16(word).tolist():
        value = (value * 31 + unit) & 0xFFFFFFFF
    return value - (1 << 32) if value >= 1 << 31 else value


@lru_cache(1 << 16)
def _places(word: str, dimension: int) -> tuple[int, int]:
    """The two hashed places of a word; words repeat, so most are looked up."""
    word = _CONCEPT_OF.get(word, word)
    first = string_hash(word)
    second = (first * 31 + len(_utf16(word)) + (1 << 31)) % (1 << 32) - (1 << 31)
    return first % dimension, second % dimension


def hash_vector(text: str, prefix: str = "query: ", dimension: int = 384) -> np.ndarray:
    """Bag of concepts: each word adds 1 and 0.5 at two hashed places; length one."""
    plain = unicodedata.normalize("NFKC", prefix + text).lower()
    words = [w for w in _BLANKS.sub(" ", plain).strip(" ").split(" ") if w.strip()]
    places = np.array([_places(w, dimension) for w in words], np.int64).reshape(-1, 2)
    # Counts and their squares are multiples of a quarter, so these sums are exact in any order.
    vector = (
        np.bincount(places[:, 0], minlength=dimension) + 0.5 * np.bincount(places[:, 1], minlength=dimension)
    ).astype(np.float32)
    norm = np.float32(np.sqrt(np.sum(vector * vector, dtype=np.float32)))
    if norm == 0:
        raise ValueError("evidence gave a zero vector")
    return vector / norm


def hash_embedding(settings: CampaignSettings = CampaignSettings()) -> Callable[[Column], Column]:
    """Column function of the deterministic embedding; equal texts are embedded once a batch."""
    prefix, dimension = settings.input_prefix, settings.dimension

    # Arrow in and out, so that a worker holds the numbers of one batch and no object for each of them.
    @F.arrow_udf(VECTOR)
    def embed(texts: pa.Array) -> pa.Array:
        vectors = np.empty((len(texts) - texts.null_count, dimension), np.float32)
        known: dict[str, int] = {}
        for row, text in enumerate(texts.drop_null().to_pylist()):
            first = known.setdefault(text, row)
            vectors[row] = vectors[first] if first < row else hash_vector(text, prefix, dimension)
        return list_array(vectors, texts.is_null())

    return embed


def list_array(rows: np.ndarray, missing: pa.BooleanArray | None = None) -> pa.ListArray:
    """The rows of a matrix as one list each; null where ``missing`` says so, which has no row."""
    size = len(rows) if missing is None else len(missing)
    there = np.ones(size, np.int64) if missing is None else 1 - missing.to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(there) * rows.shape[1])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1)), mask=missing)


def _sha256(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


def check_manifest(manifest: dict, settings: CampaignSettings, model_path: str, tokenizer_path: str) -> None:
    """Raise unless the manifest describes this configuration and exactly these files."""
    expected = {
        "modelVersion": settings.model_version, "embeddingDimension": settings.dimension,
        "pooling": "MEAN", "inputPrefix": settings.input_prefix, "maxTokens": settings.max_tokens,
    }
    wrong = [name for name, value in expected.items() if manifest.get(name) != value]
    if wrong:
        raise ValueError(f"embedding manifest does not match the configuration: {', '.join(wrong)}")
    for name, path in (("modelSha256", model_path), ("tokenizerSha256", tokenizer_path)):
        if _sha256(path).lower() != str(manifest.get(name, "")).lower():
            raise ValueError(f"embedding artifact checksum mismatch: {path}")


def unit_rows(rows: np.ndarray, dimension: int) -> np.ndarray:
    """Rows scaled to length one; wrong sizes, non-finite and zero rows are errors."""
    rows = np.asarray(rows, dtype=np.float32)
    if rows.shape[1] != dimension:
        raise ValueError(f"unexpected embedding dimension {rows.shape[1]}")
    squares = np.sum(rows * rows, axis=1, keepdims=True, dtype=np.float32)
    if not np.isfinite(squares).all() or (squares == 0).any():
        raise ValueError("embedding has a zero or invalid norm")
    return rows / np.sqrt(squares)


def onnx_embedding(
    model_path: str, tokenizer_path: str, manifest_path: str, settings: CampaignSettings,
    batch_size: int = 64,
) -> Callable[[Column], Column]:
    """Column function of a local ONNX sentence model with mean pooling.

    The three paths must be readable on every executor (a shared mount or ``--files``).
    """

    # An iterator UDF, so that a worker loads the model once and not once per batch.
    @F.pandas_udf(VECTOR)
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import onnxruntime
        from tokenizers import Tokenizer

        with open(manifest_path, encoding="utf-8") as file:
            check_manifest(json.load(file), settings, model_path, tokenizer_path)
        session = onnxruntime.InferenceSession(model_path, providers=["CPUExecutionProvider"])
        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.enable_truncation(settings.max_tokens)
        tokenizer.enable_padding()
        wanted = {i.name for i in session.get_inputs()}
        for texts in batches:
            rows: list = [None] * len(texts)
            present = [i for i, t in enumerate(texts) if t is not None]
            for start in range(0, len(present), batch_size):
                chosen = present[start:start + batch_size]
                encoded = tokenizer.encode_batch([settings.input_prefix + texts.iloc[i] for i in chosen])
                mask = np.array([e.attention_mask for e in encoded], dtype=np.int64)
                feeds = {
                    "input_ids": np.array([e.ids for e in encoded], dtype=np.int64),
                    "attention_mask": mask, "token_type_ids": np.zeros_like(mask),
                }
                states = session.run(None, {n: v for n, v in feeds.items() if n in wanted})[0]
                weights = mask[:, :, None].astype(np.float32)
                pooled = (states * weights).sum(axis=1) / weights.sum(axis=1)
                for i, row in zip(chosen, unit_rows(pooled, settings.dimension)):
                    rows[i] = row
            yield pd.Series(rows)

    return embed
