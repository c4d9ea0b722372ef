"""Token counts with a whole-token shortcut: pre-tokens that are proved to be one token count as one; only
the rest is merged."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_texts, text_chunks
from .tokens import alphabet, counter


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary's strings that, encoded alone, give exactly one token: found by encoding each."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    ids = sorted(set(t.get_vocab().values()) - set(t.get_added_tokens_decoder()))
    texts = [x for x in t.decode_batch([[i] for i in ids]) if x and "�" not in x]
    return frozenset(x for x, e in zip(texts, t.encode_batch_fast(texts, add_special_tokens=False), strict=True) if len(e.ids) == 1)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Number of tokens of every whole text by the vocabulary at path, without added special tokens.

    Returns id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit), one row per row of docs; null
    text is empty and has none, a null id stays null. Other columns are not read. The proved strings
    and the classes of code points are broadcast; both are bounded by the vocabulary. There is no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast((alphabet(path), whole_tokens(path)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path, *shared.value)
        for ids, texts in text_chunks(batches):
            counts = own.count(as_texts(texts))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts), pa.array(counts > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return source.mapInArrow(counted, "id long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
