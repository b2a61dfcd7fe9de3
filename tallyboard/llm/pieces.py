"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A model of pieces without inner word marks never merges across a word mark that follows
another character, nor across a line feed that no piece holds, so texts fall into words.
The distinct words of a chunk lie in one flat array of symbols. A round looks up the rank
of every adjacent pair, takes the smallest rank of each word, merges its leftmost
occurrences at once, and compacts the arrays; words without a pair drop out. Characters
without a piece become byte pieces. Ids are those of the sentencepiece library without
begin or end marks and without sampling.

Merging several occurrences at once equals merging one by one unless a merge gives birth
to a pair that goes first; occurrences after such a merge wait for the next round.

A round over a long word would look at all its places for each rank. Words of more than
LONG symbols have rounds of their own, which look only at the places of the smallest rank:
symbols are linked to their neighbours, and places wait under the rank of their pair.

Defined results: null text is empty text, which has no ids; repeated rows stay repeated;
other columns play no part, whatever their names; an empty table gives an empty result.
Texts of any length are encoded whole, in memory proportional to the longest one.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyboard.llm.common import col

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
CODE_POINTS = 0x110000
NO_RANK = np.iinfo(np.int64).max

# Characters of the texts that are encoded together.
CHUNK = 2_000_000
# Words of more characters have rounds that look at the places of one rank alone.
LONG = 4_096


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Pieces:
    """Lookup arrays of a BPE model: characters, pairs, byte pieces and piece bytes."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, trainer, pieces = proto.normalizer_spec, proto.trainer_spec, proto.pieces
        kinds = np.array([p.type for p in pieces])
        if (trainer.model_type != trainer.BPE or not trainer.byte_fallback or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or trainer.treat_whitespace_as_suffix or np.isin(kinds, (USER_DEFINED, UNUSED)).any()):
            raise ValueError("needs a BPE model with byte fallback and plain normalisation")
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.size = len(pieces)
        ids = {p.piece: i for i, p in enumerate(pieces) if p.type == NORMAL}
        self.char_ids = self.size + np.arange(CODE_POINTS, dtype=np.int64)
        for s, i in ids.items():
            if len(s) == 1:
                self.char_ids[ord(s)] = i

        def symbol(s: str) -> int | None:
            return ids.get(s, self.size + ord(s) if len(s) == 1 else None)

        # Equal scores share a rank; a higher score goes first.
        scores = sorted({pieces[i].score for i in ids.values()}, reverse=True)
        rank = {score: r for r, score in enumerate(scores)}
        self.wide = self.size + CODE_POINTS + 1  # one more, so that -1 makes no pair
        keys, merged, ranks = [], [], []
        birth = np.full(self.size, NO_RANK)  # smallest rank of a piece that begins or ends with this one
        for s, i in ids.items():
            r = rank[pieces[i].score]
            for cut in range(1, len(s)):
                a, b = symbol(s[:cut]), symbol(s[cut:])
                for part in (a, b):
                    if part is not None and part < self.size:
                        birth[part] = min(birth[part], r)
                if a is not None and b is not None:
                    keys.append(a * self.wide + b)
                    merged.append(i)
                    ranks.append(r)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        # A last entry that no pair has keeps every search inside the arrays.
        self.keys = np.append(np.array(keys, np.int64)[order], NO_RANK)
        self.merged = np.append(np.array(merged, np.int64)[order], -1)
        self.ranks = np.append(np.array(ranks, np.int64)[order], NO_RANK)
        own = np.full(self.size, -1)
        own[list(ids.values())] = [rank[pieces[i].score] for i in ids.values()]
        self.may_preempt = birth <= own
        self.byte_ids = np.zeros(256, np.int64)
        texts = []
        for i, p in enumerate(pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                texts.append(bytes([value]))
            else:
                texts.append(b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode())
        self.text_lengths = np.array([len(t) for t in texts], np.int64)
        self.text_starts = np.cumsum(self.text_lengths) - self.text_lengths
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        if any(MARK in s.lstrip(MARK) for s in ids):
            self.words = re.compile(r"(?s).+")
        elif any("\n" in s for s in ids):
            self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        else:
            self.words = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the pair table) of pairs; NO_RANK where no piece is made."""
        key = left * self.wide + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), at

    def merge_words(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their number per word after all merges; words are not empty."""
        done_symbols, done_words, done_lengths = [], [], []
        word = np.arange(len(lengths))
        of = np.repeat(word, lengths)
        ranks, at = np.full(len(symbols), NO_RANK), np.zeros(len(symbols), np.int64)
        fresh = np.arange(len(symbols))  # places whose pair with the next symbol is new
        while len(word):
            fresh = fresh[(fresh >= 0) & (fresh + 1 < len(symbols))]
            inner = of[fresh] == of[fresh + 1]
            ranks[fresh[~inner]] = NO_RANK
            fresh = fresh[inner]
            ranks[fresh], at[fresh] = self._rank(symbols[fresh], symbols[fresh + 1])
            best = np.minimum.reduceat(ranks, np.cumsum(lengths) - lengths)
            over = best == NO_RANK
            if over.any():
                leaving = over[of]
                done_symbols.append(symbols[leaving])
                done_words.append(word[over])
                done_lengths.append(lengths[over])
                symbols, ranks, at = symbols[~leaving], ranks[~leaving], at[~leaving]
                word, lengths, best = word[~over], lengths[~over], best[~over]
                of = np.repeat(np.arange(len(word)), lengths)
            hits = np.flatnonzero(ranks == best[of])
            # Of hits that overlap in a row every other one merges, from the left.
            alone = np.append(True, hits[1:] != hits[:-1] + 1)[:len(hits)]
            run = np.maximum.accumulate(np.where(alone, np.arange(len(hits)), 0))
            hits = hits[(np.arange(len(hits)) - run) % 2 == 0]
            hits = self._until_preempted(hits, symbols, of, self.merged[at[hits]], best)
            symbols[hits] = self.merged[at[hits]]
            staying = np.ones(len(symbols), bool)
            staying[hits + 1] = False
            lengths = lengths - np.bincount(of[hits], minlength=len(word))
            symbols, of, ranks, at = symbols[staying], of[staying], ranks[staying], at[staying]
            # A word's last symbol has no pair; a merged one has new pairs on both sides.
            ranks[np.cumsum(lengths) - 1] = NO_RANK
            places = hits - np.arange(len(hits))
            fresh = np.concatenate([places - 1, places])
        lengths = np.concatenate(done_lengths) if done_lengths else np.zeros(0, np.int64)
        flat = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int64)
        back = np.argsort(np.concatenate(done_words)) if done_words else np.zeros(0, np.int64)
        starts = np.cumsum(lengths) - lengths
        return flat[_ragged(starts[back], lengths[back])], lengths[back]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols of one long word after all merges."""
        n = len(symbols)
        symbols = np.append(symbols, -1)  # the neighbour of the first and of the last place
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        before[0], after[n] = n, n
        ranks, at = np.full(n + 1, NO_RANK), np.zeros(n + 1, np.int64)
        waiting: dict[int, list[np.ndarray]] = defaultdict(list)
        todo: list[int] = []  # heap of the ranks that have places

        def look(places: np.ndarray) -> None:
            """Files places under the rank of their pair with the next one."""
            found, ranked = self._rank(symbols[places], symbols[after[places]])
            ranks[places], at[places] = found, ranked
            order = np.argsort(found, kind="stable")
            found, places = found[order], places[order]
            cuts = np.flatnonzero(np.diff(found, prepend=-1))
            for rank, some in zip(found[cuts].tolist(), np.split(places, cuts[1:])):
                if rank != NO_RANK:
                    if rank not in waiting:
                        heapq.heappush(todo, rank)
                    waiting[rank].append(some)

        look(np.arange(n))
        while todo:
            rank = heapq.heappop(todo)
            hits = np.concatenate(waiting.pop(rank))
            hits = np.unique(hits[ranks[hits] == rank])
            if not len(hits):
                continue
            # Of hits that overlap in a row every other one merges, from the left.
            alone = np.append(True, after[hits[:-1]] != hits[1:])
            run = np.maximum.accumulate(np.where(alone, np.arange(len(hits)), 0))
            chosen = hits[(np.arange(len(hits)) - run) % 2 == 0]
            merged = self.merged[at[chosen]]
            risky = np.flatnonzero(self.may_preempt[merged])
            if len(risky):
                # In sequence the left neighbour is merged already, the right one not yet.
                h, m = chosen[risky], merged[risky]
                touching = (risky > 0) & (after[after[chosen[risky - 1]]] == h)
                left = np.where(touching, merged[risky - 1], symbols[before[h]])
                bad = (self._rank(left, m)[0] <= rank) | (self._rank(m, symbols[after[after[h]]])[0] <= rank)
                if bad.any():
                    until = risky[np.argmax(bad)] + 1
                    if until < len(chosen):
                        waiting[rank].append(hits[hits >= chosen[until]])
                        heapq.heappush(todo, rank)
                    chosen, merged = chosen[:until], merged[:until]
            gone = after[chosen]
            symbols[chosen] = merged
            symbols[gone], ranks[gone] = -1, NO_RANK
            # A place that is merged away has no neighbour that is: hits do not overlap.
            after[chosen] = after[gone]
            before[after[chosen]] = chosen
            left = before[chosen]
            look(np.unique(np.concatenate([left[left < n], chosen])))
        return symbols[:n][symbols[:n] >= 0]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their number per word after all merges, of words of any length."""
        long = lengths > LONG
        if not long.any():
            return self.merge_words(symbols, lengths)
        ends = np.cumsum(lengths)
        short, few = self.merge_words(symbols[np.repeat(~long, lengths)], lengths[~long])
        parts = [short, *(self.merge_long(symbols[e - n:e]) for e, n in zip(ends[long], lengths[long]))]
        # Short words lie first, long ones after them; ``place`` says which is which.
        sizes = np.concatenate([few, np.array([len(p) for p in parts[1:]], np.int64)])
        place = np.empty(len(lengths), np.int64)
        place[np.concatenate([np.flatnonzero(~long), np.flatnonzero(long)])] = np.arange(len(lengths))
        starts = np.cumsum(sizes) - sizes
        return np.concatenate(parts)[_ragged(starts[place], sizes[place])], sizes[place]

    def _until_preempted(self, hits, symbols, of, merged, best) -> np.ndarray:
        """Of each word, the hits up to the first whose merge makes a pair that goes first."""
        risky = np.flatnonzero(self.may_preempt[merged])
        if not len(risky):
            return hits
        h, m, limit = hits[risky], merged[risky], best[of[hits[risky]]]
        # In sequence the left neighbour is merged already, the right one not yet.
        touching = (risky > 0) & (hits[risky - 1] + 2 == h)
        left = np.where(touching, merged[risky - 1], symbols[h - 1])
        has_left = (h > 0) & (of[h - 1] == of[h])
        after = np.minimum(h + 2, len(symbols) - 1)
        has_right = (h + 2 < len(symbols)) & (of[after] == of[h])
        bad = has_left & (self._rank(left, m)[0] <= limit) | has_right & (self._rank(m, symbols[after])[0] <= limit)
        if not bad.any():
            return hits
        first = np.full(of[-1] + 1, len(symbols))
        np.minimum.at(first, of[h[bad]], h[bad])
        return hits[hits <= first[of[hits]]]

    def _bytes_for_unknown(self, symbols: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their text number: characters without a piece as their UTF-8 byte pieces."""
        unknown = symbols >= self.size
        if not unknown.any():
            return symbols, of
        points, where = np.unique(symbols[unknown] - self.size, return_inverse=True)
        coded = [chr(p).encode() for p in points.tolist()]
        sizes = np.array([len(c) for c in coded], np.int64)
        lengths = np.ones(len(symbols), np.int64)
        lengths[unknown] = sizes[where]
        out = np.repeat(symbols, lengths)
        flat = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        out[np.repeat(unknown, lengths)] = flat[_ragged((np.cumsum(sizes) - sizes)[where], sizes[where])]
        return out, np.repeat(of, lengths)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their number per text."""
        index: dict[str, int] = defaultdict(count().__next__)  # a new word gets the next number
        numbers = []
        for text in texts:
            found = self.words.findall(self.prefix + text.replace(" ", MARK)) if text else []
            numbers.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
        if not index:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        lengths = np.fromiter(map(len, index), np.int64, len(index))
        points = np.frombuffer("".join(index).encode("utf-32-le"), np.uint32)
        symbols, lengths = self.merge(self.char_ids[points], lengths)
        symbols, of = self._bytes_for_unknown(symbols, np.repeat(np.arange(len(lengths)), lengths))
        lengths = np.bincount(of, minlength=len(lengths))
        starts = np.cumsum(lengths) - lengths
        counts = np.array([lengths[n].sum() for n in numbers], np.int64)
        every = np.concatenate(numbers)
        return symbols[_ragged(starts[every], lengths[every])], counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids that ``encode`` gave; the mark before the first word is taken off."""
        flat = self.text_bytes[_ragged(self.text_starts[ids], self.text_lengths[ids])].tobytes()
        ends = np.cumsum(np.append(0, self.text_lengths[ids]))[np.cumsum(np.append(0, counts))].tolist()
        skip = len(self.prefix)
        return [flat[a + (skip if flat[a:a + 1] == b" " else 0):b].decode("utf-8", "replace")
                for a, b in zip(ends, ends[1:])]


def _chunks(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of about CHUNK characters together, at least one."""
    chunk, size = [], 0
    for t in texts:
        chunk.append(t or "")
        size += len(chunk[-1])
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, ids, and the text decoded from the ids.

    The model file (some hundred kilobytes) is read by the driver and travels with the
    job, so executors need no copy of it.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(model)
        for batch in batches:
            done = 0
            for chunk in _chunks(batch.column("text").to_pylist()):
                ids, counts = pieces.encode(chunk)
                offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(done, len(chunk)),
                     pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                     pa.array(pieces.decode(ids, counts), pa.string())], ["doc_id", "ids", "decoded"])
                done += len(chunk)

    narrow = docs.select(col(id_col).alias("doc_id"), col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Number of ids and digests of the ids (decimal, joined by commas) and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                          F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
