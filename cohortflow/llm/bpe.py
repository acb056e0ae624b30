"""Byte-pair encoding by a pair occurrence index, and decoding (operator 13).

A text is cut into pieces that no merge crosses, by the classes of its characters. The
pieces of a partition that its worker has not met are laid end to end, and an index maps
the rank of each pair of neighbouring symbols to all places where it occurs. Active ranks
are applied in ascending order from a heap: every place of a rank is merged from left to
right, and the places of the two pairs that a merge makes are added to their ranks'
lists. Places whose symbols have changed meanwhile are passed over. A symbol takes part
only in pairs of higher ranks than the one that made it, which is checked when the
vocabulary is read, so this gives what merging each piece by itself gives.

Pieces are known by 64-bit hashes from slice to slice. Decoding looks up every id's bytes.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortflow.llm.common import documents
from cohortflow.llm.packing import Numbers
from cohortflow.llm.shingles import release, spans_hash, text_slices

#: Distinct pieces that a Python worker remembers from task to task.
CACHE = 1_000_000
#: Ids that are decoded at once, or those of one row.
SPELT = 1 << 18
LETTER, NUMBER, OTHER, WHITE, SPACE = 1, 2, 3, 4, 5
APOSTROPHE = ord("'")
#: Fixed values of the byte-level vocabulary: what may follow an apostrophe as a piece of its own.
SHORT, LONG = "stmd", ("re", "ve", "ll")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next free one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """The ids of bytes, the merges by rank, and the bytes of ids, from a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        stated = json.loads(Path(path).read_text(encoding="utf-8"))
        model, before = stated["model"], stated["pre_tokenizer"]
        odd = stated["normalizer"] or before != before | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} or model.get("ignore_merges")
        if odd or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in stated["added_tokens"]):
            raise ValueError(f"{path}: not a byte-level vocabulary without normal forms")
        ids, letters = model["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.of_byte = np.array([ids[c] for c in letters], dtype=np.int64)
        self.special = {t["content"].encode(): t["id"] for t in stated["added_tokens"]}
        #: What is taken out of a text first, the longest of those at a place.
        self.apart = re.compile(b"|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or b"(?!)")
        self.left, self.right, self.made = [], [], []
        #: By its left symbol, and by its right one: the other symbol and the rank of each pair.
        self.with_left: dict[int, dict[int, int]] = {}
        self.with_right: dict[int, dict[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.left.append(ids[a])
            self.right.append(ids[b])
            self.made.append(ids[a + b])
            self.with_left.setdefault(ids[a], {})[ids[b]] = r
            self.with_right.setdefault(ids[b], {})[ids[a]] = r
        last = dict(zip(self.made, range(len(self.made)), strict=True))
        if any(max(last.get(a, -1), last.get(b, -1)) >= r for r, (a, b) in enumerate(zip(self.left, self.right, strict=True))):
            raise ValueError(f"{path}: a merge comes before its parts are made")
        #: Ranks of pairs of bytes; as many as there are merges where there is none.
        self.first = np.full((256, 256), len(self.made), dtype=np.int64)
        at = {i: b for b, i in enumerate(self.of_byte.tolist())}
        for r, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            if a in at and b in at:
                self.first[at[a], at[b]] = r
        spelt = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()} | {i: s for s, i in self.special.items()}
        raw = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        self.bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.length = np.array([len(b) for b in raw], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.kinds = np.zeros(0x110000, dtype=np.uint8)

    def classes(self, points: np.ndarray) -> np.ndarray:
        """Letters, numbers, others and white space as the library sees them: it is asked about each character when it is first met."""
        kinds = self.kinds[points]
        if not kinds.all():
            for p in np.unique(points[kinds == 0]).tolist():
                joins = [len(self.split(c + chr(p))) == 1 for c in "a1!"]
                self.kinds[p] = SPACE if p == 0x20 else joins.index(True) + 1 if any(joins) else WHITE
            kinds = self.kinds[points]
        return kinds

    def pieces(self, points: np.ndarray, edges: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Where pieces begin. ``edges``: where texts, and strings taken out of them, begin or end; ``inside``: the rest of those strings."""
        n = len(points)
        kind = self.classes(points)
        group = np.minimum(kind, WHITE)
        edge = np.zeros(n + 1, dtype=bool)
        edge[edges] = edge[n] = True
        begin = edge.copy()
        begin[1:n] |= group[1:] != group[:-1]
        # The last blank before a word: a space goes with the word, another is a piece of its own.
        last = np.flatnonzero((group[:-1] == WHITE) & (group[1:] != WHITE) & ~edge[1:n])
        begin[last] = True
        begin[last[kind[last] == SPACE] + 1] = False
        quote = np.flatnonzero((points == APOSTROPHE) & begin[:n])
        quote = quote[quote + 1 < n]
        quote = quote[~edge[quote + 1]]
        after = points[quote + 1]
        second = np.where(edge[np.minimum(quote + 2, n)], 0, points[np.minimum(quote + 2, n - 1)])
        short = np.isin(after, [ord(c) for c in SHORT])
        long = np.zeros(len(quote), dtype=bool)
        for a, b in LONG:
            long |= (after == ord(a)) & (second == ord(b))
        begin[quote[short | long] + 1] = False
        begin[quote[short] + 2] = True
        begin[quote[long] + 3] = True
        begin[inside] = False
        return np.flatnonzero(begin[:n])

    def merged(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, whose bytes are end to end, and how many each has: by the occurrence index over all of them."""
        ends, n, none = np.cumsum(sizes), len(raw), len(self.made)
        cut = np.zeros(n, dtype=bool)  # after this place a piece ends
        cut[ends - 1] = True
        ranks = np.full(n, none, dtype=np.int64)
        ranks[:-1] = self.first[raw[:-1], raw[1:]]
        ranks[cut] = none
        order = np.argsort(ranks, kind="stable")
        order = order[: np.searchsorted(ranks[order], none)]
        active, firsts = np.unique(ranks[order], return_index=True)
        index = {r: at.tolist() for r, at in zip(active.tolist(), np.split(order, firsts[1:]), strict=True)}
        symbol = self.of_byte[raw].tolist()
        after = np.where(cut, -1, np.arange(1, n + 1)).tolist()
        before = np.where(np.concatenate([[True], cut[:-1]]), -1, np.arange(-1, n - 1)).tolist()
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            rank = heapq.heappop(heap)
            left, right, made = self.left[rank], self.right[rank], self.made[rank]
            to_right, to_left = self.with_left.get(made), self.with_right.get(made)
            places = index.pop(rank)
            if left == right:
                places.sort()  # of places that overlap the leftmost is merged
            for p in places:
                q = after[p]
                if q < 0 or symbol[p] != left or symbol[q] != right:
                    continue
                symbol[p], symbol[q] = made, -1
                q = after[p] = after[q]
                if q >= 0:
                    before[q] = p
                    if to_right and (new := to_right.get(symbol[q])) is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(heap, new)
                if to_left and (q := before[p]) >= 0 and (new := to_left.get(symbol[q])) is not None:
                    if new in index:
                        index[new].append(q)
                    else:
                        index[new] = [q]
                        heapq.heappush(heap, new)
        ids = np.array(symbol, dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(ids >= 0)])
        return ids[ids >= 0], upto[ends] - upto[ends - sizes]

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ``ids`` end to end, and how many each has. Ids that the vocabulary lacks have none."""
        known = (ids >= 0) & (ids < len(self.length))
        ids = np.where(known, ids, 0)
        length = np.where(known, self.length[ids], 0)
        ends = np.cumsum(length)
        at = np.repeat(self.start[ids] - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.bytes[at], length


class Encoder:
    """Ids of whole texts; the ids of pieces that were met before are kept in a pool."""

    def __init__(self, path: str) -> None:
        self.vocabulary = Vocabulary(path)
        self.clear()

    def clear(self, slots: int = 1 << 21) -> None:
        self.known = Numbers(slots)
        self.pool, self.used = np.zeros(1 << 20, dtype=np.int32), 0
        self.start, self.length = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64)

        for text, i in self.vocabulary.special.items():
            one = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
            self.add(spans_hash(one, np.zeros(1, np.int64), np.array([len(text)])), np.array([i]), np.ones(1, np.int64))

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

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts ``data[offsets[i]:offsets[i + 1]]`` end to end, and where each begins (and the end)."""
        if not len(data):
            return np.zeros(0, dtype=np.int32), np.zeros(len(offsets), dtype=np.int64)
        raw = data.tobytes()
        lead = (data & 0xC0) != 0x80
        at = np.append(np.flatnonzero(lead), len(data))  # the bytes of characters
        edges, inside = [np.searchsorted(at, offsets)], []
        for found in self.vocabulary.apart.finditer(raw):
            a, b = found.span()
            if not ((offsets > a) & (offsets < b)).any():
                a, b = np.searchsorted(at, [a, b]).tolist()
                edges.append(np.array([a, b]))
                inside.append(np.arange(a + 1, b))
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        begin = self.vocabulary.pieces(points, np.concatenate(edges), np.concatenate(inside) if inside else np.zeros(0, dtype=np.int64))
        starts = at[begin]
        ends = np.append(starts[1:], len(data))
        hashes = spans_hash(data.astype(np.uint64) + np.uint64(1), starts, ends)
        inverse, u = pd.factorize(hashes)
        index = self.known.get(u)
        new = np.flatnonzero(index < 0)
        if len(new) and self.known.count + len(new) > CACHE:
            self.clear(max(1 << 21, 1 << (4 * len(u)).bit_length()))
            new = np.flatnonzero(self.known.get(u) < 0)
        if len(new):
            where = np.empty(len(u), dtype=np.int64)
            where[inverse[::-1]] = np.arange(len(hashes))[::-1]
            begin, size = starts[where[new]], (ends - starts)[where[new]]
            upto = np.cumsum(size)
            self.add(u[new], *self.vocabulary.merged(data[np.repeat(begin - (upto - size), size) + np.arange(int(upto[-1]))], size))
            index = self.known.get(u)
        each = index[inverse]
        length = self.length[each]
        upto = np.concatenate([[0], np.cumsum(length)])
        ids = self.pool[np.repeat(self.start[each] - upto[:-1], length) + np.arange(int(upto[-1]))]
        return ids, upto[np.searchsorted(starts, offsets)]


#: Loaded once in each Python worker.
loaded: dict[str, Encoder] = {}


def encoder_for(path: str) -> Encoder:
    if path not in loaded:
        loaded[path] = Encoder(path)
    return loaded[path]


def encoding(path: str):
    """``doc_id, text`` to ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                ids, at = encoder.texts(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(lists)), lists], names=["doc_id", "ids"])
        release()

    return run


def decoding(path: str, column: int, names: list[str]):
    """Rows with the list of ids in one ``column`` to the same rows with their texts, which come last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder_for(path).vocabulary
        for batch in batches:
            lists = batch.column(column)
            ids = lists.flatten()
            upto = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            first = 0
            while first < len(batch):
                last = max(first + 1, int(np.searchsorted(upto, upto[first] + SPELT, side="right")) - 1)
                some = ids.slice(upto[first], upto[last] - upto[first]).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                raw, length = vocabulary.spell(some)
                raw, at = raw.tobytes(), np.concatenate([[0], np.cumsum(length)])[upto[first : last + 1] - upto[first]].tolist()
                texts = [raw[a:b].decode("utf-8", errors="replace") for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in batch.columns), pa.array(texts, pa.string())], names=names)
                first = last
        release()

    return run


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row of ``df``: the token ids of its whole text as the library gives them, without added ones.

    A string of an added token inside a text is that token, as is the library's default. A null or empty text
    has no ids; rows with null or equal ids are encoded like any other; an empty table gives no rows; other columns
    are not read. A task holds one text whole, at some 100 bytes for each of its bytes, and what it knows of a million pieces.
    """
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(encoding(path), "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each row's list of ids as ``out``, special tokens as their strings.

    A null or empty list gives an empty text; ids that the vocabulary lacks, and null ones, have no bytes;
    bytes that are no UTF-8 become replacement characters, as the library has it.
    """
    return df.mapInArrow(decoding(path, df.columns.index(ids_col), [*df.columns, out]), StructType([*df.schema.fields, StructField(out, StringType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    both = decode(encode(documents(spark, sf_dir), path), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
