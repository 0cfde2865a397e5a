"""Token ids as Parquet list columns: written in document order, read by column, row group and page."""

from __future__ import annotations

import os
import zlib
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varve.llm.common import parts_for, pieces, text_of
from varve.session import broadcast_if_small

# Bytes of text whose tokens one file holds, and the rows one file may have.
FILE_BYTES, FILE_ROWS = 64 << 20, 1_000_000
# Parts of words whose ids a worker remembers in each of two generations, and the longest.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64

# Letters and digits up to the word's end or to a mark after which the library never joins them.
_WORD = "(?s)^(?P<stem>[A-Za-z0-9À-ÖØ-öø-ÿ]+)(?P<rest>(?:[.,;:!?#&$*()\"].*)?)$"
# Words that go through the library in one call, and bytes of text worked on at once.
TOGETHER, CHUNK_BYTES = 10_000, 4 << 20


@dataclass(frozen=True)
class Layout:
    """How the files are laid out.

    ``encoding`` of the ids is ``dictionary`` (best while a file has fewer different ids than some
    ten thousands) or ``delta``. The other columns, which rise or vary little, are always delta
    encoded. Every row group and page has its entry in the page index of its file.
    """

    encoding: str = "dictionary"
    group_bytes: int = 16 << 20
    page_bytes: int = 256 << 10
    page_rows: int = 1_000
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.encoding not in ("dictionary", "delta"):
            raise ValueError(f"unknown encoding {self.encoding}")
        return {
            "compression": self.codec,
            "parquet.block.size": str(self.group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(self.encoding == "dictionary").lower(),
        }


@lru_cache(maxsize=2)
def _tokenizer(spec: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_str(spec)
    made.no_truncation()
    made.no_padding()
    return made


def _spliced(pool: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of a pool one after another, and their sizes; ``sizes`` are those of all runs in it."""
    starts, counts = np.cumsum(sizes) - sizes, sizes[chosen]
    shift = np.repeat(starts[chosen] - (np.cumsum(counts) - counts), counts)
    shift += np.arange(len(shift))
    return pool[shift], counts


class WordEncoder:
    """Ids of texts, for tokenizers that fold case and drop white space before they merge.

    Such a tokenizer gives a text the ids of its words, one after another, and a word of letters and a
    mark the ids of both; so only stems and rests that are not remembered go through the library.
    """

    def __init__(self, spec: str, end: int | None):
        self.library = _tokenizer(spec)
        self.end = end
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        vocabulary = self.library.get_vocab()
        self.ending = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ending[[n for t, n in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encoded(self, words: list[str]) -> None:
        """Put words through the library, many in a call, and remember their ids.

        The library numbers the words of a call, but for added tokens; words that hold one go alone. Where
        ids tell the end of a word, and there are as many ends as words, numbers are not asked for.
        """
        joined = "\n".join(words)
        added = [a for a in self.added if a in joined]
        alone = [w for w in words if any(a in w for a in added)] if added else []
        for word, made in zip(alone, self.library.encode_batch_fast(alone, add_special_tokens=False)):
            self.new[word] = np.array(made.ids, "<u4").tobytes()
        words = [w for w in words if w not in self.new] if alone else words
        for kind in (True, False):
            same = [w for w in words if w.isalpha() == kind]
            for at in range(0, len(same), TOGETHER):
                some = same[at : at + TOGETHER]
                ids, ends = self._ended(some) if kind else (None, None)
                if ids is None:
                    made = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
                    ids, ends = made.ids, np.cumsum(np.bincount(np.array(made.word_ids, np.int64), minlength=len(some)))
                data, ends = np.array(ids, "<u4").tobytes(), (ends * 4).tolist()
                self.new.update(zip(some, [data[i:j] for i, j in zip([0, *ends], ends)]))

    def _ended(self, words: list[str]) -> tuple[list[int] | None, np.ndarray | None]:
        """Ids of words and where each word ends among them, if their ids say so."""
        if not self.ending.any():
            return None, None
        ids = self.library.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids
        ends = np.flatnonzero(self.ending[np.array(ids, np.int64)]) + 1
        return (ids, ends) if len(ends) == len(words) and ends[-1] == len(ids) else (None, None)

    def _remembered(self, parts: list[str]) -> None:
        """See that the distinct ``parts`` are in the memory."""
        unknown = []
        for part in [p for p in parts if p not in self.new]:
            if part in self.old:
                self.new[part] = self.old[part]
            else:
                unknown.append(part)
        self._encoded(unknown)
        self.new[""] = b""

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id last, and where each text ends among them.

        Words are cut at the six ASCII spaces; any other white space is left to the library.
        """
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        # A word is a stem and a rest, either of which may be empty.
        cut = pc.extract_regex(words.dictionary, _WORD)
        stems = pc.utf8_lower(pc.fill_null(cut.field("stem"), "")).dictionary_encode()
        rests = pc.if_else(cut.is_valid(), cut.field("rest"), words.dictionary).dictionary_encode()
        dictionary = pa.concat_arrays([stems.dictionary, rests.dictionary])
        parts = dictionary.to_numpy(zero_copy_only=False).tolist()
        self._remembered(parts)
        ids = list(map(self.new.__getitem__, parts))
        for n in np.flatnonzero(pc.utf8_length(dictionary).to_numpy() > REMEMBERED_CHARS).tolist():
            self.new.pop(parts[n], None)
        if len(self.new) > REMEMBERED:
            self.new, self.old = {}, self.new
        pool = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        halves = np.stack([stems.indices.to_numpy(), rests.indices.to_numpy() + len(stems.dictionary)], axis=1).astype(np.int64).reshape(-1)
        pool, sizes = _spliced(pool, sizes, halves)
        flat, sizes = _spliced(pool, sizes.reshape(-1, 2).sum(axis=1), words.indices.to_numpy())
        before = np.append(0, np.cumsum(sizes))
        ends = before[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]
        if self.end is not None:
            flat = np.insert(flat, ends, self.end)
            ends = ends + np.arange(1, len(ends) + 1)
        return flat, ends


@lru_cache(maxsize=1)
def _encoder(spec: str, end: int | None) -> WordEncoder:
    """The encoder of a worker, which remembers words from task to task."""
    return WordEncoder(spec, end)


def _ordered(docs: DataFrame, id_column: str, text: Column) -> DataFrame:
    """(id, text), in ranges of ascending ids, each sorted.

    Nulls come first. Rows of one id are ordered by the hash of their text, and a place in the input
    tells equal rows apart, so that no id or text is bound to one range.
    """
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    size = chosen.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    files = max(parts_for(size["rows"], FILE_ROWS), parts_for(size["bytes"] or 0, FILE_BYTES))
    keyed = chosen.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place"))
    return keyed.repartitionByRange(files, "id", "hash", "place").sortWithinPartitions("id", "hash", "place").select("id", "text")


def write_tokens(
    docs: DataFrame, path: str, spec: str, end: int | None = None, id_column: str = "doc_id", text: Column | None = None, layout: Layout = Layout()
) -> None:
    """Encode every text and write the ids, in ascending order of the documents, as files below ``path``.

    ``spec`` is the text of a tokenizer file whose tokenizer folds case and drops white space. ``path/data`` holds a
    row a document: ``part`` (its file's number, in order), ``at`` (ids before it in that file),
    ``doc_id``, ``n_tokens`` and ``ids``. ``path/parts`` has a row a file: its ids and rows, and
    the ids ``before`` it. Texts are shuffled once, to their range; ids are never shuffled.

    Null texts count as empty and still get the end id; a null id comes first; rows of one id stay rows
    each, by the hash of their text. A long text needs memory in proportion to itself, in one task. An
    empty table makes a ``data`` of no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ordered = _ordered(docs, id_column, text_of() if text is None else text)

    def run(batches):
        part, at, encoder = TaskContext.get().partitionId(), 0, _encoder(spec, end)
        for piece in pieces(batches, "text", CHUNK_BYTES):
            ids, ends = encoder.encode(piece.column(1))
            counts, places = np.diff(ends, prepend=0), at + np.append(0, ends[:-1])
            at += len(ids)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32)))
            made = [pa.array(np.full(len(ends), part), pa.int32()), pa.array(places), piece.column(0), pa.array(counts), lists]
            yield pa.RecordBatch.from_arrays(made, names=["part", "at", "doc_id", "n_tokens", "ids"])

    kind = ordered.schema["id"].dataType.simpleString()
    rows = ordered.mapInArrow(run, f"part int, at long, doc_id {kind}, n_tokens long, ids array<int>")
    rows.write.options(**layout.options()).parquet(f"{path}/data")
    # One row a file: its sums, then what lies before it.
    sizes = spark.read.parquet(f"{path}/data").groupBy("part").agg(F.sum("n_tokens"), F.count("*")).collect()
    before, parts = 0, []
    for part, tokens, count in sorted(tuple(r) for r in sizes):
        parts.append((part, before, tokens, count))
        before += tokens
    spark.createDataFrame(parts, "part int, before long, n_tokens long, n_docs long").coalesce(1).write.parquet(f"{path}/parts")


@dataclass(frozen=True)
class TokenFiles:
    """What :func:`write_tokens` wrote, read back. Every method reads only the columns and pages it needs."""

    spark: SparkSession
    path: str
    rows: Column | None = None

    def where(self, condition: Column) -> TokenFiles:
        """Only documents with ``condition`` on ``doc_id`` or ``n_tokens``, which the scan is given."""
        return replace(self, rows=condition if self.rows is None else self.rows & condition)

    def _data(self) -> DataFrame:
        data = self.spark.read.parquet(f"{self.path}/data")
        return data if self.rows is None else data.where(self.rows)

    def parts(self) -> DataFrame:
        """(part, before, n_tokens, n_docs) of each file."""
        return self.spark.read.parquet(f"{self.path}/parts")

    def _placed(self, data: DataFrame) -> DataFrame:
        parts = self.parts().select("part", "before")
        return data.join(broadcast_if_small(parts, parts.count()), "part").withColumn("start", F.col("before") + F.col("at"))

    def documents(self) -> DataFrame:
        """(doc_id, start, n_tokens), without reading any ids."""
        return self._placed(self._data().select("part", "at", "doc_id", "n_tokens")).select("doc_id", "start", "n_tokens")

    def tokens(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids)."""
        return self._placed(self._data()).select("doc_id", "start", "n_tokens", "ids")

    def span(self, first: int, last: int) -> DataFrame:
        """(doc_id, start, ids) of the ids from place ``first`` on and before ``last``, over all documents.

        The files that overlap the span are found among the parts; in them ``at`` rises, so the scan
        skips all row groups and pages beyond the span.
        """
        held = self.parts().where((F.col("before") < last) & (F.col("before") + F.col("n_tokens") > first)).collect()
        inside = F.lit(False)
        for r in held:
            at = F.col("at") < last - r["before"]
            inside = inside | ((F.col("part") == r["part"]) & at & (F.col("at") + F.col("n_tokens") > first - r["before"]))
        rows = self._placed(self._data().where(inside)).withColumn("from", F.greatest(F.lit(first) - F.col("start"), F.lit(0)))
        to = F.least(F.lit(last) - F.col("start"), F.col("n_tokens"))
        cut = F.slice("ids", (F.col("from") + 1).cast("int"), F.greatest(to - F.col("from"), F.lit(0)).cast("int"))
        return rows.select("doc_id", (F.col("start") + F.col("from")).alias("start"), cut.alias("ids"))


def id_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows with ``ids``: crc32 of the little-endian 32-bit ids."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
            digests = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            made = [*batch.columns[:3], pa.array(digests, pa.int64())]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")

