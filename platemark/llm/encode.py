"""Encoding of a corpus with a public byte-level vocabulary.

The words of all documents (as the vocabulary's pattern splits them) are
counted, each partition adding up its own before the shuffle. The most frequent
ones are compiled, with their ids, into a minimal acyclic transducer that is
written to the cluster's shared folder, fetched once per executor and mapped
into memory. Encoding then splits a batch, looks its distinct words up in the
transducer all at once, and merges exactly what isn't there. The ids don't
depend on which words are in the lexicon; only the speed does.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platemark.llm import vocab
from platemark.llm.transducer import Transducer, compile_lexicon, to_bytes
from platemark.session import shared_path

#: Most words of the lexicon (bounds what the driver compiles and an executor fetches), and their most bytes.
LEXICON_WORDS, LEXICON_BYTES = 65_536, 48
#: Characters of a text whose words are counted at once.
STRETCH = 1_000_000
#: Distinct words a task remembers the merges of before it starts anew.
REMEMBER = 200_000
#: Characters of text that are split at once.
CHUNK = 4_000_000


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts: words as the pattern splits them, whole texts, all rows; counted without leaving the JVM.

    A text of more than STRETCH characters is taken in stretches of that size,
    whose words are all that is held at once. A word across two of them, or of
    characters that the encoder's own splitter should class in another way,
    is counted as what isn't looked up later: that costs time, never a wrong id.
    """
    length = F.length(text)
    stretches = F.transform(F.sequence(F.lit(0), F.floor((length - 1) / STRETCH).cast("int")), lambda i: F.substr(F.col(text), i * STRETCH + 1, F.lit(STRETCH)))
    texts = df.filter(F.col(text) != "").select(F.explode(F.when(length <= STRETCH, F.array(text)).otherwise(stretches)).alias("t"))
    words = texts.select(F.explode(F.regexp_extract_all("t", F.lit(vocab.PATTERN), 0)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def build_lexicon(df: DataFrame, text: str, ranks: dict[bytes, int]) -> str:
    """Compiles the most frequent words of ``df``; returns the name of the file that tasks get by SparkFiles."""
    spark = df.sparkSession
    frequent = word_counts(df, text).filter(F.octet_length("word") <= LEXICON_BYTES).orderBy(F.desc("n"), "word").limit(LEXICON_WORDS)
    words = sorted(r["word"].encode() for r in frequent.select("word").collect())
    flat = compile_lexicon(words, [vocab.merge(w, ranks) for w in words])
    path = shared_path(spark, "lexicon") + ".npy"
    _write(spark, path, to_bytes(flat))
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _write(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes into the shared folder, whatever file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    for at in range(0, len(content), 8_000_000):
        out.write(bytearray(content[at : at + 8_000_000]))
    out.close()


class Encoder:
    """Encodes lists of texts; equal to the public encoders on every text."""

    def __init__(self, ranks: dict[bytes, int], lexicon: Transducer | None = None) -> None:
        self.ranks, self.lexicon = ranks, lexicon
        self.merged: dict[bytes, list[int]] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and ids."""
        split = vocab.splitter().findall
        words: list[str] = []
        ends = [0]
        for t in texts:
            if t:
                words.extend(split(t))
            ends.append(len(words))
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        distinct = [w.encode() for w in number]
        found = self.lexicon.find(distinct) if self.lexicon else np.full(len(distinct), -1)
        size = np.zeros(len(distinct), np.int64)
        seen = np.flatnonzero(found >= 0)
        if len(seen):
            size[seen] = self.lexicon.offsets[found[seen] + 1] - self.lexicon.offsets[found[seen]]
        unseen = np.flatnonzero(found < 0).tolist()
        merged = [self._merge(distinct[i]) for i in unseen]
        size[unseen] = [len(m) for m in merged]
        begin = np.concatenate(([0], np.cumsum(size)))
        table = np.zeros(begin[-1], np.int32)
        if len(seen):
            table[_spans(begin[seen], size[seen])] = self.lexicon.ids[_spans(self.lexicon.offsets[found[seen]], size[seen])]
        for i, m in zip(unseen, merged, strict=True):
            table[begin[i] : begin[i + 1]] = m
        order = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        ids = table[_spans(begin[order], size[order])]
        return np.concatenate(([0], np.cumsum(size[order])))[ends], ids

    def _merge(self, word: bytes) -> list[int]:
        ids = self.merged.get(word)
        if ids is None:
            if len(self.merged) >= REMEMBER:
                self.merged.clear()
            ids = vocab.merge(word, self.ranks)
            if len(word) <= 256:
                self.merged[word] = ids
        return ids


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions begin[i] .. begin[i] + size[i] - 1, one span after the other."""
    total = int(size.sum())
    shift = np.repeat(begin - np.concatenate(([0], np.cumsum(size)))[:-1], size)
    return np.arange(total) + shift


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str | None = None) -> DataFrame:
    """(``key``, ids) for every row: ids of ``text`` without special tokens.

    Null and empty texts have the empty list. Strings of special tokens are
    ordinary text. Blank, repeated and very long texts (of any length, cut
    nowhere) are encoded like others. Repeated rows stay repeated, an empty
    table gives an empty result. Columns other than the two are not read.
    """
    ranks = vocab.load_ranks(vocabulary or vocab.vocabulary_path())
    lexicon = build_lexicon(df, text, ranks)
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shared.value, Transducer.load(SparkFiles.get(lexicon)))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(t) if t else 0 for t in texts])
            at = 0
            while at < len(texts):
                stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, "right")))
                offsets, ids = encode(texts[at:stop])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, stop - at), lists], ["id", "ids"])
                at = stop

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key).alias("id"), F.col(text).alias("t")).mapInArrow(run, f"id {kind}, ids array<int>").toDF(key, "ids")
