"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks that overlap, and tasks pre-tokenise them in parallel. Where
the ends of pre-tokens of a chunk and of the one before it agree, both go on alike, so the
first common end is where they are stitched. Chunks without a common end (a run of letters
longer than the overlap) are joined and pre-tokenised again, until every pair has one. The
pieces between stitches are encoded in parallel, and their ids put one after the other. A
text of one chunk is a piece of its own. Decoding concatenates the bytes of the ids.

A pre-token is encoded by merges of the adjacent pair with the smallest rank, the leftmost
first; the ids are those of the tiktoken library without special tokens.

Defined results: null text is empty text, which has no ids; repeated rows stay repeated;
other columns play no part, whatever their names; an empty table gives an empty result.
Texts of any length are encoded whole; the ids of one text are one cell, so they meet in one
task, as the text does.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyboard.llm.common import col
from tallyboard.session import scratch_table

CHUNK = 1 << 16  # characters of a chunk, without the overlap
OVERLAP = 1 << 10
# A pre-token that ends at least so far before the end of a chunk is not changed by what follows the chunk:
# the longest alternatives of fixed text have three characters, the others stop at a change of character class.
LOOKAHEAD = 3
BATCH = 1 << 21  # characters that are encoded together
SHORT = 64  # characters of a pre-token that is remembered
REMEMBERED = 1 << 18
NO_RANK = 1 << 32


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token of a vocabulary file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _portable(pattern: str) -> str:
    """The pattern with the classes it means: blanks by their Unicode property, the end of the whole text."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(
        r"\S", r"\P{White_Space}").replace("$", r"\Z")


class _Known(dict):
    """Packed ids of pre-tokens met before; long ones are not kept."""

    def __init__(self, pack: Callable[[str], bytes]):
        super().__init__()
        self.pack = pack

    def __missing__(self, token: str) -> bytes:
        ids = self.pack(token)
        if len(token) <= SHORT:
            self[token] = ids
        return ids


class Encoder:
    """Pre-tokens of a text, and the packed ids (little-endian, 32 bits) of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.words = regex.compile(_portable(pattern))
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.known = _Known(self._packed)

    def ends(self, text: str, start: int = 0) -> list[int]:
        """Where the pre-tokens of a text end, for a text that begins at ``start``."""
        found = [m.end() for m in self.words.finditer(text)]
        if (found[-1] if found else 0) != len(text):
            raise ValueError("the pattern must match every character")
        return [e + start for e in found]

    def encode(self, tokens: list[str]) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, tokens))

    def encode_text(self, text: str) -> bytes:
        tokens = self.words.findall(text)
        if sum(map(len, tokens)) != len(text):
            raise ValueError("the pattern must match every character")
        return self.encode(tokens)

    def _packed(self, token: str) -> bytes:
        raw = token.encode()
        rank = self.ranks.get(raw)
        ids = [rank] if rank is not None else self._few(raw) if len(raw) <= 2 * SHORT else self._many(raw)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _few(self, raw: bytes) -> list[int]:
        """Merges one by one, each after a look at all pairs."""
        get = self.ranks.get
        parts = [raw[i:i + 1] for i in range(len(raw))]
        ranks = [get(raw[i:i + 2], NO_RANK) for i in range(len(raw) - 1)]
        while ranks and (best := min(ranks)) != NO_RANK:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], NO_RANK)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], NO_RANK)
        return [self.ranks[p] for p in parts]

    def _many(self, raw: bytes) -> list[int]:
        """Merges from a heap of (rank, place), for long pre-tokens."""
        n, get = len(raw), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the next and the previous part
        now: list[int | None] = [get(raw[i:i + 2]) for i in range(n - 1)] + [None]  # rank of a part and the next
        heap = [(r, i) for i, r in enumerate(now) if r is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if now[i] != rank:  # one of the two has been merged since
                continue
            gone = after[i]
            after[i], now[gone] = after[gone], None
            if after[i] < n:
                before[after[i]] = i
            now[i] = get(raw[i:after[after[i]]]) if after[i] < n else None
            if now[i] is not None:
                heapq.heappush(heap, (now[i], i))
            left = before[i]
            if left >= 0:
                now[left] = get(raw[left:after[i]])
                if now[left] is not None:
                    heapq.heappush(heap, (now[left], left))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[raw[i:after[i]]])
            i = after[i]
        return ids


def _slices(sizes: list[int]) -> Iterator[slice]:
    """Consecutive rows of about BATCH characters together, at least one."""
    begin, size = 0, 0
    for i, n in enumerate(sizes):
        size += n
        if size >= BATCH:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def _whole(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Texts of one chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s in _slices([len(t) for t in texts]):
                ids = [encoder.encode_text(t) for t in texts[s]]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(s.start, len(ids)), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def _chunks(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, number, start, text): overlapping chunks of every text, spread over tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                starts = range(0, max(1, len(text) - overlap), chunk)
                for few in (starts[k:k + 64] for k in range(0, len(starts), 64)):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").take([i] * len(few)), batch.column("doc_id").take([i] * len(few)),
                         pa.array([s // chunk for s in few], pa.int32()), pa.array(few, pa.int32()),
                         pa.array([text[s:s + chunk + overlap] if s != starts[-1] else text[s:] for s in few], pa.string())],
                        ["row", "doc_id", "number", "start", "text"])

    # Written with its row numbers, so that a task that runs again finds the same ones.
    numbered = scratch_table(docs.withColumn("row", F.monotonically_increasing_id()), "long_texts")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(run, f"row bigint, doc_id {kind}, number int, start int, text string").repartition("row", "number")


def _with_ends(chunks: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Adds where pre-tokens end, within the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ends = encoder.ends(one.column("text")[0].as_py(), one.column("start")[0].as_py())
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([ends], pa.list_(pa.int32()))], [*one.schema.names, "ends"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema.fields)
    return chunks.mapInArrow(run, f"{schema}, ends array<int>")


def _stitches(chunks: DataFrame) -> DataFrame:
    """(row, number, stitch): the first end that a chunk and the one before it have in common, if any; 0 for the first."""
    stop = F.col("start") + F.char_length("text")
    order = Window.partitionBy("row").orderBy("number")
    # What lies in the overlap alone is compared: a thousand ends at most.
    narrow = chunks.select("row", "number", "start", stop.alias("stop"), "ends").withColumn("next", F.lead("start").over(order))
    narrow = narrow.withColumns({
        "tail": F.filter("ends", lambda e: (e >= F.col("next")) & (e <= F.col("stop") - LOOKAHEAD)),
        "before": F.lag("stop").over(order)})
    head = F.filter("ends", lambda e: e <= F.least("before", F.when(F.col("next").isNull(), F.col("stop")).otherwise(F.col("stop") - LOOKAHEAD)))
    common = F.array_min(F.array_intersect(F.lag("tail").over(order), head))
    return narrow.select("row", "number", F.when(F.col("before").isNull(), F.lit(0)).otherwise(common).alias("stitch"))


def _joined(chunks: DataFrame, stitches: DataFrame) -> DataFrame:
    """Chunks without a stitch joined to the one before; (row, doc_id, number, start, text)."""
    order = Window.partitionBy("row").orderBy("number")
    part = F.count("stitch").over(order) - 1
    numbered = stitches.withColumn("part", part.cast("int")).select("row", "number", "part")
    parts = chunks.drop("ends").join(numbered, ["row", "number"]).groupBy("row", "part").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("start", "text"))).alias("found"))
    # Of every chunk but the last, what the next one does not hold.
    size = F.size("found")
    text = F.array_join(F.transform("found", lambda c, i: F.when(
        i < size - 1, F.left(c["text"], F.get(F.col("found"), i + 1)["start"] - c["start"])).otherwise(c["text"])), "")
    return parts.select("row", "doc_id", F.col("part").alias("number"), F.col("found")[0]["start"].alias("start"), text.alias("text"))


def _stitched(docs: DataFrame, ranks: dict[bytes, int], pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Texts of several chunks."""
    chunks = _chunks(docs, chunk, overlap)
    while True:
        chunks = scratch_table(_with_ends(chunks, ranks, pattern), "chunks")
        stitches = scratch_table(_stitches(chunks), "stitches")
        if stitches.where(F.col("stitch").isNull()).isEmpty():
            break
        chunks = _joined(chunks, stitches)
    until = F.lead("stitch").over(Window.partitionBy("row").orderBy("number"))
    pieces = chunks.join(stitches.withColumn("until", until), ["row", "number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                ends = [r["stitch"], *(e for e in r["ends"] if e > r["stitch"] and (r["until"] is None or e <= r["until"]))]
                ids = encoder.encode([r["text"][a - r["start"]:b - r["start"]] for a, b in zip(ends, ends[1:])])
                yield pa.RecordBatch.from_arrays([batch.column(n).slice(i, 1) for n in ("row", "doc_id", "number")] + [pa.array([ids], pa.binary())],
                                                 ["row", "doc_id", "number", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = pieces.mapInArrow(run, f"row bigint, doc_id {kind}, number int, ids binary")
    parts = F.array_sort(F.collect_list(F.struct("number", "ids")))
    return encoded.groupBy("row").agg(F.first("doc_id").alias("doc_id"), parts.alias("parts")).select(
        "doc_id", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, and its ids as in a token file (unsigned, 32 bits, little-endian)."""
    if not LOOKAHEAD < overlap <= chunk:
        raise ValueError(f"the overlap must be larger than {LOOKAHEAD} and no larger than a chunk")
    narrow = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    # Bytes bound characters, and their number is known without reading the text.
    short = F.octet_length("text") <= chunk
    return _whole(narrow.where(short), ranks, pattern).unionByName(
        _stitched(narrow.where(~short), ranks, pattern, chunk, overlap))


def id_array(ids: Column) -> Column:
    """Packed ids as an array<bigint>."""
    word = F.regexp_replace(F.hex(ids), "(..)(..)(..)(..)", "$4$3$2$1,")
    return F.transform(F.filter(F.split(word, ","), lambda w: w != ""), lambda w: F.conv(w, 16, 10).cast("bigint"))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds the decoded bytes of the packed ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: raw for raw, rank in ranks.items()}
        by_id = [token.get(i, b"") for i in range(max(token) + 1)]
        lengths = np.array([len(t) for t in by_id], np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(by_id), np.uint8)

        def raw(cell: bytes) -> bytes:
            ids = np.frombuffer(cell, "<u4")
            ends = np.cumsum(lengths[ids])
            # Position start, start + 1, ... of every token's bytes.
            return flat[np.repeat(starts[ids] - ends + lengths[ids], lengths[ids]) + np.arange(ends[-1] if len(ends) else 0)].tobytes()

        for batch in batches:
            cells = batch.column("ids").to_pylist()
            for s in _slices([len(c) for c in cells]):
                texts = [raw(c) for c in cells[s]]
                yield pa.RecordBatch.from_arrays([c.slice(s.start, len(texts)) for c in batch.columns] + [pa.array(texts, pa.binary())],
                                                 [*batch.schema.names, "decoded"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{schema}, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Number of ids and digests of packed ids and decoded bytes."""
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
