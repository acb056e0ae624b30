"""Token counts by a compiled finite-state transducer (operator 1).

A piece model merges neighbouring pieces by score, within stretches that no piece
crosses: a run of blanks with the word after it, or what follows a character outside
the vocabulary. Within such a stretch the last piece of each prefix is the one piece
that can follow the prefix before it (the pair stands when encoded by itself), so
reading one more character is a transition, and how many pieces the longer prefix
has more, or less, is the count it emits. A state is the longest end of the text that
may still grow into a piece, with the last piece and relative count at each place in it.

Transitions are compiled when first met and kept in one table, which all of a batch's
chunks step through together, a character of each at a time. A chunk that begins at a
blank has a constant state map. One cut inside a long word has a map from entry states
to exit states and counts, filled in for the states that arise, and the maps of a text's
chunks are composed by a parallel prefix scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import documents
from cohortflow.llm.shingles import text_slices

BLANK = "▁"
CHUNK = 512
#: Entries of the table; when it is full, it is emptied and compiled anew as needed.
TABLE = 1 << 24


#: Strings, each with a time: the worst rank merged so far, and the rank merged now.
Ends = tuple[tuple[str, tuple[float, float]], ...]
NEVER = (float("inf"), float("inf"))


class Pieces:
    """The vocabulary of a piece model that merges by score, and its merging of short strings."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids}
        words = [p for p in self.score if p.strip(BLANK)]
        runs = [p for p in self.score if not p.strip(BLANK)]
        self.run = max(map(len, runs))
        #: Pieces in a run of so many blanks; from the longest piece on, it begins anew.
        self.run_count = [len(self.encode(BLANK * k)) for k in range(3 * self.run)]
        repeats = all(self.run_count[k + self.run] == self.run_count[k] + 1 for k in range(2 * self.run))
        if not repeats or any(BLANK in p[1:] for p in words) or max(map(self.score.get, runs)) >= min(map(self.score.get, words)):
            raise ValueError(f"{path}: pieces cross blanks in ways that the transducer does not cover")
        if model.normalize("A  b\té") != BLANK + "A" + BLANK * 2 + "b\té":
            raise ValueError(f"{path}: texts are changed before they are cut into pieces")
        self.score = {p: self.score[p] for p in words} | {BLANK: self.score[BLANK]}
        self.chars = {c for p in self.score for c in p if c in self.score}
        #: What a longer piece begins with.
        self.prefixes = {p[:k] for p in self.score for k in range(len(p))}
        self.rank = {p: -self.score[p] for p in self.score}
        self._halves: dict[str, tuple[str, str] | None] = {}
        self._made: dict[str, tuple[float, float]] = {}
        self._spines: dict[str, tuple] = {}

    def encode(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge is the last to make ``piece``; None if it isn't made from its characters."""
        if piece not in self._halves:
            parts, last = list(piece), None
            while len(parts) > 1:
                pairs = [(self.rank[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.rank]
                if not pairs:
                    break
                i = min(pairs)[1]
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[piece] = last if len(parts) == 1 else None
        return self._halves[piece]

    def made(self, piece: str) -> tuple[float, float]:
        """When ``piece`` is made: after its parts, by the worst rank on the way, then by its own."""
        if piece not in self._made:
            rank, worst = self.rank[piece], self.rank[piece]
            for x in self.halves(piece) or ():
                if len(x) > 1:
                    worst = max(worst, self.made(x)[0])
            self._made[piece] = (worst, rank)
        return self._made[piece]

    def met(self, x: str, y: str) -> tuple[float, float] | None:
        """When ``x`` and ``y``, side by side, would merge."""
        rank = self.rank.get(x + y)
        if rank is None or y not in self.rank:
            return None
        return max([rank, *(self.made(p)[0] for p in (x, y) if len(p) > 1)]), rank

    def right_spine(self, piece: str) -> Ends:
        """The pieces at the right end while ``piece`` is made, each with the merge that ends it, if they can grow."""
        if piece not in self._spines:
            spine, until = [], NEVER
            x: str | None = piece
            while x:
                if x in self.prefixes:
                    spine.append((x, until))
                until = self.made(x)
                x = (self.halves(x) or ("", ""))[1]
            self._spines[piece] = tuple(spine)
        return self._spines[piece]

    def stands(self, clashes: Ends, piece: str) -> bool:
        """Whether ``piece`` is made and stays apart from what is before it.

        ``clashes``: beginnings of the text after a place that the piece before would merge with, and
        when it would. A merge across the place comes before one to its right of equal rank.
        """
        if len(piece) > 1 and self.halves(piece) is None:
            return False
        if not clashes:
            return True
        at, y, until = dict(clashes), piece, NEVER
        while y:
            if y in at and at[y] <= until:
                return False
            until = self.made(y)
            y = (self.halves(y) or ("", ""))[0]
        return True


#: A place in the text of a state: beginnings of what follows that would merge with the piece before, those
#: ends of the piece before that may yet merge with more of what follows, and the count up to there.
Place = tuple[Ends, Ends, int]
#: A state: the text that may still grow into a piece, and each place in it.
State = tuple[str, tuple[Place, ...]]
EMPTY: State = ("", (((), (), 0),))
#: A place from which no longer piece can start any more.
GONE: Place = ((), (), 1 << 20)


class Transducer:
    """States, their transitions and the counts these emit, compiled as they are met."""

    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.kinds = np.zeros(0x110000, dtype=np.uint16)
        known = np.array([ord(c) for c in self.pieces.chars])
        point = np.arange(0x110000)
        self.kinds[:] = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)  # as many tokens as bytes
        self.kinds[known] = 0  # gets its number when first met
        self.kinds[ord(" ")] = self.kinds[ord(BLANK)] = 5
        self.chars = ["", "", "", "", "", BLANK]
        self.width = 128
        self.clear()

    def clear(self) -> None:
        self.states: list[State | int] = []
        self.number: dict[State | int, int] = {}
        self.table = np.full((256, self.width), -1, dtype=np.int32)
        # Blank states are whole numbers: the length of the run, modulo the longest piece. The first state follows any end of a stretch.
        self.start = self.intern(EMPTY)
        self.first = self.intern(1)

    def intern(self, state: State | int) -> int:
        n = self.number.get(state)
        if n is None:
            n = self.number[state] = len(self.states)
            self.states.append(state)
            if n >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return n

    def read(self, points: np.ndarray) -> np.ndarray:
        """Code points to the columns of the table."""
        kinds = self.kinds[points]
        if not kinds.all():
            for p in np.unique(points[kinds == 0]).tolist():
                self.kinds[p] = len(self.chars)
                self.chars.append(chr(p))
            if len(self.chars) > self.width:
                while len(self.chars) > self.width:
                    self.width *= 2
                wide = np.full((len(self.table), self.width), -1, dtype=np.int32)
                wide[:, : self.table.shape[1]] = self.table
                self.table = wide
            kinds = self.kinds[points]
        return kinds

    def step(self, state: State | int, kind: int) -> tuple[State | int, int]:
        """The next state and the count emitted."""
        if kind < 5:
            return EMPTY, kind
        if kind == 5:
            if not isinstance(state, int):
                return 1, 1
            longer = state or self.pieces.run
            return (state + 1) % self.pieces.run, self.pieces.run_count[longer + 1] - self.pieces.run_count[longer]
        if isinstance(state, int):
            # The last blank begins the word's first piece, or stays a part of its run.
            longer = state or self.pieces.run
            state = (BLANK, (((), (), self.pieces.run_count[longer - 1] - self.pieces.run_count[longer]), ((), self.pieces.right_spine(BLANK), 0)))
        text, places = state
        text += self.chars[kind]
        seen = []
        for j, (clashes, ends, count) in enumerate(places):
            after = text[j:]
            if places[j] is not GONE and ends:
                met = [m for x, until in ends if (m := self.pieces.met(x, after)) and m < until]
                if met:
                    clashes = (*clashes, (after, min(met)))
                ends = tuple(e for e in ends if e[0] + after in self.pieces.prefixes)
            seen.append((clashes, ends, count))
        for j, (clashes, _, count) in enumerate(seen):
            if places[j] is not GONE and text[j:] in self.pieces.rank and self.pieces.stands(clashes, text[j:]):
                break
        else:
            raise AssertionError(f"no piece ends {text!r}")
        emitted = count + 1
        seen.append(((), self.pieces.right_spine(text[j:]), emitted))
        grows = [text[k:] in self.pieces.prefixes for k in range(len(text) + 1)]
        first = grows.index(True)
        return (text[first:], tuple((seen[k][0], seen[k][1], seen[k][2] - emitted) if grows[k] else GONE for k in range(first, len(seen)))), emitted

    def compile(self, state: int, kind: int) -> None:
        to, emitted = self.step(self.states[state], kind)
        n = self.intern(to)
        self.table[state, kind] = n << 8 | emitted + 128

    def run(self, kinds: np.ndarray, begin: np.ndarray, end: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exit state and count of each chunk ``kinds[begin:end]`` from its entry state, all in step."""
        order = np.argsort(begin - end, kind="stable")
        at, left = begin[order], (end - begin)[order]
        state, count = entry[order].astype(np.int64), np.zeros(len(begin), dtype=np.int64)
        live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        for k, n in enumerate(live.tolist()):
            kind = kinds[at[:n] + k].astype(np.int64)
            flat = state[:n] * self.width + kind
            got = self.table.ravel()[flat]
            if (got < 0).any():
                if len(self.states) * self.width > TABLE:
                    self.shrink(state)
                    flat = state[:n] * self.width + kind
                    got = self.table.ravel()[flat]
                for f in np.unique(flat[got < 0]).tolist():
                    self.compile(f // self.width, f % self.width)
                got = self.table.ravel()[flat]
            count[:n] += (got & 255) - 128
            state[:n] = got >> 8
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        return state[back], count[back]

    def shrink(self, state: np.ndarray) -> None:
        """Empty the table but for the states that chunks are in."""
        used, where = np.unique(state, return_inverse=True)
        kept = [self.states[s] for s in used.tolist()]
        self.clear()
        state[:] = np.array([self.intern(s) for s in kept])[where]

    def counts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The tokens of each text ``points[bounds[i]:bounds[i + 1]]``."""
        texts = len(bounds) - 1
        kinds = self.read(points)
        full = np.flatnonzero(np.diff(bounds) > 0)
        out = np.zeros(texts, dtype=np.int64)
        if not len(full):
            return out
        out[full] = 1  # the blank that is put before a text
        blank = kinds == 5
        sync = np.flatnonzero(blank & ~np.concatenate([[True], blank[:-1]]))
        lo, hi = bounds[full], bounds[full + 1]
        cuts = [np.arange(a + CHUNK, b, CHUNK) for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if b - a > CHUNK]
        nominal = np.concatenate(cuts) if cuts else np.zeros(0, dtype=np.int64)
        i = np.searchsorted(sync, nominal)
        moved = np.where(i < len(sync), sync[np.minimum(i, len(sync) - 1)], len(points)) if len(sync) else np.full(len(nominal), len(points))
        at = np.where(moved < nominal + CHUNK, moved, nominal)
        begin = np.unique(np.concatenate([lo, at]))
        owner = np.searchsorted(lo, begin, side="right") - 1
        end = np.append(begin[1:], hi[-1])
        head = begin == lo[owner]
        fixed = head | np.isin(begin, sync)
        entry = np.where(head, self.first, self.start)
        exits, count = self.run(kinds, begin, end, entry)
        np.add.at(out, full[owner[fixed]], count[fixed])
        if not fixed.all():
            self.compose(kinds, begin, end, fixed, entry, exits, count, full[owner], out)
        return out

    def compose(self, kinds, begin, end, fixed, entry, exits, count, owner, out) -> None:
        """Add the counts of chunks cut inside a stretch, from the state in which the one before ends.

        States are kept by value here: a full table may be numbered anew meanwhile.
        """
        open_at = np.flatnonzero(~fixed)
        maps: dict[int, dict] = {c: {} for c in open_at.tolist()}
        exit_of = {c: self.states[exits[c]] for c in {c - 1 for c in maps} | set(maps)}
        for c in maps:
            maps[c][EMPTY] = (exit_of[c], int(count[c]))
        while True:
            done, missing = scan(maps, {c: exit_of[c] for c in {c - 1 for c in maps} - set(maps)})
            if not missing:
                break
            todo = np.array([c for c, _ in missing])
            into = np.array([self.intern(s) for _, s in missing])
            to, n = self.run(kinds, begin[todo], end[todo], into)
            for (c, s), t, k in zip(missing, to.tolist(), n.tolist(), strict=True):
                maps[c][s] = (self.states[t], k)
        for c, k in done.items():
            out[owner[c]] += k


def scan(maps: dict[int, dict], roots: dict[int, State | int]) -> tuple[dict[int, int], list[tuple[int, State | int]]]:
    """Each chunk's count from its true entry state, by doubling: or the entries that maps still lack.

    In round r a chunk's map covers the 2^r chunks up to it. A chain starts at a chunk whose exit is known.
    A composed map has the entries for which both halves have been computed.
    """
    span: dict[int, tuple[int, dict]] = {c: (c - 1, {e: s for e, (s, _) in m.items()}) for c, m in maps.items()}
    while any(back not in roots for back, _ in span.values()):
        longer = {}
        for c, (back, f) in span.items():
            if back in roots:
                longer[c] = (back, f)
            else:
                further, g = span[back]
                longer[c] = (further, {e: f[s] for e, s in g.items() if s in f})
        span = longer
    done, missing = {}, []
    for c in maps:
        if c - 1 in roots:
            state = roots[c - 1]
        else:
            back, f = span[c - 1]
            state = f.get(roots[back])
        if state is not None and state in maps[c]:
            done[c] = maps[c][state][1]
        elif state is not None:
            missing.append((c, state))
    if not missing and len(done) < len(maps):
        raise AssertionError("a chain of chunks has no start")
    return done, missing


#: Compiled on in each Python worker, from task to task.
machines: dict[str, Transducer] = {}


def machine_for(path: str) -> Transducer:
    if path not in machines:
        machines[path] = Transducer(path)
    return machines[path]


def count_texts(path: str):
    """``doc_id, text`` to ``doc_id, n_bytes, n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_for(path)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                lead = (data & 0xC0) != 0x80
                bounds = np.concatenate([[0], np.cumsum(lead)])[offsets]
                points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
                n = machine.counts(points, bounds)
                if len(machine.states) * machine.width > TABLE:
                    machine.clear()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(np.diff(offsets)), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    return run


LIMIT = 4096


def token_counts(df: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``df``, whatever other columns it has.

    Counts are of the whole text as the library gives them, without begin or end. A null or empty
    text has none. Rows with null or equal ids are counted like any other; an empty table gives no rows.
    A text is held whole by its task, at some 40 bytes for each of its bytes.
    """
    out = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count_texts(path), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
