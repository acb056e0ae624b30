"""Mixture-controlled packing (operator 7).

Every source is a queue of token ids. Windows of some sequences each are filled by a
deficit round robin: in each round a source's deficit grows by its quantum, the window
times the source's share of all tokens; whole tokens of it are sent and the rest is
carried on. With tokens as the unit a source has sent floor(rounds * quantum) tokens
after so many rounds, whatever came between, so any task can tell from a row's place in
its queue which windows its tokens fall into and where: deficits carry across windows
and partitions without passing anything on. Windows stand end to end and are cut into
sequences, so that only the last sequence of all is not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import cut, documents, running_total
from cohortflow.llm.shingles import lowered, release, spans_hash, text_slices, words

LENGTH = 2048
#: Sequences in a window.
WINDOW = 32
END = 1
#: Distinct chunks between white space whose ids a Python worker remembers from task to task, and the slots of their table.
CACHE, SLOTS = 1_000_000, 1 << 21
#: Bytes of text looked up at once: the more, the fewer distinct chunks for each.
SLICE = 1 << 20

_IDS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])
IDS = "row long, doc_id long, source string, n long, ids binary"
_PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Numbers:
    """Numbers of 64-bit keys in a table of open slots, looked up and added whole arrays at a time."""

    def __init__(self, slots: int = SLOTS) -> None:
        self.key, self.number, self.mask, self.count = np.zeros(slots, dtype=np.uint64), np.full(slots, -1, dtype=np.int32), slots - 1, 0

    def places(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(20)).astype(np.int64) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those not there."""
        out, at = np.full(len(keys), -1, dtype=np.int64), self.places(keys)
        left = np.arange(len(keys))
        while len(left):
            found = self.number[at]
            hit = (found >= 0) & (self.key[at] == keys[left])
            out[left[hit]] = found[hit]
            more = ~hit & (found >= 0)
            left, at = left[more], at[more] + 1 & self.mask
        return out

    def add(self, keys: np.ndarray) -> None:
        """Number keys that are not there, each once, from the count on."""
        at, left = self.places(keys), np.arange(len(keys))
        while len(left):
            free = self.number[at] < 0
            self.number[at[free]], self.key[at[free]] = self.count + left[free], keys[left[free]]
            lost = self.key[at] != keys[left]  # the slot was taken, or another of these took it
            left, at = left[lost], at[lost] + 1 & self.mask
        self.count += len(keys)


class ChunkTokenizer:
    """Ids of whole texts from the ids of their chunks between white space, which the tokenizer drops.

    Chunks are known by a 64-bit hash, so only new ones are taken out of the text, and those are
    encoded in one call. Chunks of letters that no normal form changes are one word each, so their ids
    end where a word does; a stop after such a chunk is a word of its own. Other chunks are parted by the
    end-of-text string, which the tokenizer always takes out first; texts that might hold such strings
    themselves are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.part = "<|endoftext|>"
        self.part_id = self.tokenizer.token_to_id(self.part)
        if self.encode(f"a{self.part}b").tolist().count(self.part_id) != 1 or self.encode("A \t b\n").tolist() != self.encode("a b").tolist():
            raise ValueError(f"{path}: texts can't be encoded by their chunks")
        vocab = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        stops = {ord(c): self.encode(c) for c in ".,"}
        self.stop = {c: int(ids[0]) for c, ids in stops.items() if len(ids) == 1}
        self.clear()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def clear(self) -> None:
        self.known = Numbers()
        self.pool, self.used = np.zeros(1 << 20, dtype=np.uint32), 0
        self.start, self.length = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)

    def add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, first = len(keys), self.known.count
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while first + n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.pool[self.used : self.used + len(ids)] = ids
        self.length[first : first + n] = lengths
        self.start[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        self.known.add(keys)

    def learn(self, keys: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Add the chunks ``low[starts:ends]`` by their keys."""
        raw = low.tobytes()

        def chunks(at: np.ndarray) -> list[bytes]:
            return [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]

        letters = (low - 97 < 26).astype(np.uint8)  # ASCII ones, then Latin-1 ones of two bytes
        if len(low) > 1:
            two = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] < 0xC0) & (low[1:] & 0x5F != 0x17))
            letters[two] = letters[two + 1] = 1
        upto = np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])
        count, size = upto[ends] - upto[starts], ends - starts
        last = low[ends - 1]
        pure = np.flatnonzero(count == size)
        stopped = np.flatnonzero((count == size - 1) & (size > 1) & np.isin(last, list(self.stop)))
        bases = spans_hash(low.astype(np.uint64) + np.uint64(1), starts[stopped], ends[stopped] - 1)
        new = (self.known.get(bases) < 0) & ~np.isin(bases, keys[pure])
        alone, at = np.unique(bases[new], return_index=True)
        if len(pure) or len(alone):
            ids = self.encode(b" ".join([*chunks(pure), *(c[:-1] for c in chunks(stopped[new][at]))]).decode())
            self.add(np.concatenate([keys[pure], alone]), ids, np.diff(np.flatnonzero(self.ends_word[ids]), prepend=-1))
        if len(stopped):
            at = self.known.get(bases)
            length = self.length[at] + 1
            edge = np.cumsum(length)
            where = np.repeat(self.start[at] - (edge - length), length) + np.arange(int(edge[-1]))
            ids = self.pool[np.minimum(where, self.used - 1)]
            ids[edge - 1] = [self.stop[c] for c in last[stopped].tolist()]
            self.add(keys[stopped], ids, length)
        rest = np.ones(len(keys), dtype=bool)
        rest[pure] = rest[stopped] = False
        rest = np.flatnonzero(rest)
        other = chunks(rest)
        odd = np.array([b"<|" in c for c in other], dtype=bool)
        if not odd.all():
            ids = self.encode(self.part.join(c.decode() for c, x in zip(other, odd.tolist(), strict=True) if not x))
            edges = np.concatenate([[-1], np.flatnonzero(ids == self.part_id), [len(ids)]])
            self.add(keys[rest[~odd]], ids[ids != self.part_id], np.diff(edges) - 1)
        self.add(keys[rest[odd]], np.zeros(0, dtype=np.uint32), np.zeros(int(odd.sum()), dtype=np.int64))  # not used

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts ``data[offsets[i]:offsets[i + 1]]`` end to end, and where each begins (and the end)."""
        starts, ends, hashes, first = words(data, offsets)
        inverse, u = pd.factorize(hashes)
        where = np.empty(len(u), dtype=np.int64)
        where[inverse[::-1]] = np.arange(len(hashes))[::-1]
        index = self.known.get(u)
        new = np.flatnonzero(index < 0)
        if len(new) and self.known.count + 2 * len(new) > CACHE:
            self.clear()
            new = np.arange(len(u))
            while len(self.known.key) < 4 * len(new):  # a single text of more chunks
                self.known = Numbers(2 * len(self.known.key))
        if len(new):
            at = where[new]
            self.learn(u[new], lowered(data), starts[at], ends[at])
            index = self.known.get(u)
        at = index[inverse]
        length = self.length[at]
        upto = np.concatenate([[0], np.cumsum(length)])
        step = np.ones(int(upto[-1]), dtype=np.int64)  # within a chunk the next id is the next of the pool
        some = length > 0
        begin, heads = self.start[at][some], upto[:-1][some]
        if len(begin):
            step[heads] = begin - np.concatenate([[0], begin[:-1] + length[some][:-1] - 1])
        ids, bounds = self.pool[np.cumsum(step)], upto[first]
        raw = data.tobytes()
        if b"<|" in raw:
            each = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                if b"<|" in raw[a:b]:
                    each[i] = self.encode(raw[a:b].decode())
            ids, bounds = np.concatenate(each), np.concatenate([[0], np.cumsum([len(e) for e in each])])
        return ids, bounds


#: Loaded once in each Python worker.
loaded: dict[str, ChunkTokenizer] = {}


def tokenizer_for(path: str) -> ChunkTokenizer:
    if path not in loaded:
        loaded[path] = ChunkTokenizer(path)
    return loaded[path]


def tokenized(path: str):
    """``doc_id, text, source`` to ids, under numbers of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_for(path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1), SLICE):
                ids, at = tokenizer.texts(data, offsets)
                small = not len(ids) or int(ids.max()) < 65_536
                raw, width = ids.astype("<u2" if small else "<u4").tobytes(), 2 if small else 4
                n, edges = len(at) - 1, at.tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(np.diff(at) + 1), pa.array([raw[width * a : width * b] for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())], schema=_IDS)
                row += n
        release()

    return run


def spread(shares: list[int], length: int, window: int):
    """``doc_id, n, ids, idx, at`` (source number and place in its queue) to pieces. ``shares``: tokens of each source."""
    total, span = sum(shares), length * window

    def sent(s: int, rounds: int) -> int:
        return min(rounds * span * shares[s] // total, shares[s]) if total else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: dict[int, list[int]] = {}

        def window_starts(k: int) -> list[int]:
            """The place in the whole of each source's run in window k."""
            if k not in starts:
                if len(starts) * len(shares) > 1 << 18:
                    starts.clear()
                at, out = sum(sent(s, k) for s in range(len(shares))), []
                for s in range(len(shares)):
                    out.append(at)
                    at += sent(s, k + 1) - sent(s, k)
                starts[k] = out
            return starts[k]

        for batch in batches:
            out: list[list[int]] = [[] for _ in _PIECES]
            for row in batch.to_pylist():
                n, s, at = row["n"], row["idx"], row["at"]
                width = 2 if len(row["ids"]) == 2 * (n - 1) else 4
                ids = np.append(np.frombuffer(row["ids"], dtype=f"<u{width}"), END).astype("<u4")
                start = 0
                # The first window after which more than ``at`` tokens have been sent.
                k = at * total // (span * shares[s])
                while sent(s, k + 1) <= at:
                    k += 1
                while start < n:
                    run_end = min(at + n, sent(s, k + 1)) - at
                    place = window_starts(k)[s] + at + start - sent(s, k)
                    while start < run_end:
                        take = min(run_end - start, length - place % length)
                        crc = zlib.crc32(ids[start : start + take].tobytes())
                        for c, v in zip(out, (row["doc_id"], start, take, crc, n, place // length, place % length), strict=True):
                            c.append(v)
                        start, place = start + take, place + take
                    k += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in out], schema=_PIECES)

    return run


def pack(df: DataFrame, path: str, length: int = LENGTH, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The pieces of all rows' ids, with the end id, in sequences of ``length``: ``PIECES``.

    Each window of ``window`` sequences holds every source in its share of all tokens, to the token, as far as
    whole tokens go. A queue's rows are in the order of md5 of id, checksum of the ids and their number, so that the
    result is the same however the input is split. A null or empty text is its end id alone;
    a null source is a source, the first; rows with null or equal ids stay apart; an empty table gives no rows. Columns
    but the three named are not read. The sources' totals, a number each, go to the driver and to all tasks.
    """
    sent = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").cast("string").alias("source"))
    rows = cut(sent.mapInArrow(tokenized(path), IDS), "pack-ids")
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.crc32("ids"), "n"))
    narrow = cut(rows.select("row", "doc_id", "source", "n", key.alias("_h")), "pack-rows")
    shares = narrow.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.col("source").asc_nulls_first()).collect()
    if not shares:
        return df.sparkSession.createDataFrame([], PIECES)
    names = df.sparkSession.createDataFrame([(r["source"], i) for i, r in enumerate(shares)], "source string, idx int")
    placed = narrow.join(names, narrow["source"].eqNullSafe(names["source"])).select("row", "doc_id", "n", "_h", "idx", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int").alias("_part"))
    placed = cut(running_total(placed, ["idx"], "_part", [F.col(c) for c in ("_h", "n", "row")], "n", "at").select("row", "idx", "at"), "pack-places")
    at = rows.join(placed, "row").select("doc_id", "n", "ids", "idx", "at")
    return at.mapInArrow(spread([r["n"] for r in shares], length, window), PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
