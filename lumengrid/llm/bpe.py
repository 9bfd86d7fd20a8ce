"""Byte-level BPE: a lazily determinised transducer encodes, an incremental UTF-8 state machine decodes.

Encoding. A sequence of tokens is what merging by rank gives exactly if each two neighbours are (merging their joined
bytes gives those two back). So of all tokens that end at a byte, exactly one may follow the tokens before it, and the
non-deterministic transducer reads: a hypothesis is a list of tokens and a partial token (a prefix in the vocabulary);
a byte prolongs the partial token, and where that is a token that may follow, a hypothesis with it done is added.
Determinising it as bytes come gives states that are sets of (tokens not yet emitted, partial token); tokens that all
hypotheses share are emitted. A hypothesis lives no longer than the longest token, which bounds the lookahead. States and
transitions are made when first needed and kept, up to a bound.

Decoding. Tokens are fed one after another; whole characters come out, and at most three bytes of an unfinished one are
held. A token's effect on the machine is looked up, or worked out byte by byte once.

Edge cases: null text counts as empty (0 tokens); text from Spark is valid UTF-8, ids from elsewhere may give invalid
bytes, which decode to themselves and are counted; repeated rows and null ids are kept, one output row per input row;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common, pieces

#: White space as Unicode's White_Space property has it.
_WS = r"\t-\r\x20\x85\xa0  -     　"


def piece_pattern(pattern: str) -> str:
    """The pattern with \\s and \\S written out, which libraries take differently (control characters 1C-1F)."""
    return common.spelt(pattern.replace(r"\S", f"[^{_WS}]"), {r"\s": _WS})


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


#: States of a transducer and bytes of known pieces that a worker keeps; the second pair where other stages need the memory.
STATES, PIECES = 150_000, 200 << 20
FEW_STATES, FEW_PIECES = 15_000, 16 << 20


class Transducer:
    """Bytes of one piece to token ids."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = STATES):
        self.ranks, self.most = ranks, most_states
        self.name = {r: b for b, r in ranks.items()}
        #: Every prefix of a token: (its rank or -1, whether a longer token has it as a prefix).
        self.prefix: dict[bytes, tuple[int, bool]] = {}
        only = (-1, True)  # one for all that are no tokens
        for t in ranks:
            for i in range(1, len(t)):
                part = t[:i]
                if (at := self.prefix.get(part)) is None or not at[1]:
                    self.prefix[part] = only if (r := ranks.get(part)) is None else (r, True)
            self.prefix.setdefault(t, (ranks[t], False))
        self.follows: dict[tuple[int, int], bool] = {}
        self.edges: dict[int, tuple[list, list]] = {}
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.moves: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.last: list[tuple[int, ...]] = []
        self.seen: set[int] = set()
        self._state((-1, (((), b""),)))

    def merged(self, piece: bytes) -> list[int]:
        """Tokens of piece by merging the neighbours of least rank, the leftmost first, until none can be."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _edges(self, token: int) -> tuple[list, list]:
        """Parts that stand at the right and at the left edge while the token is merged: (part, its rank, rank of the
        merge that ends it). Empty lists if merging its bytes doesn't give the token."""
        if (got := self.edges.get(token)) is None:
            if len(self.edges) > self.most // 4:
                self.edges.clear()
            ranks, piece = self.ranks, self.name[token]
            parts = [piece[i : i + 1] for i in range(len(piece))]
            right, left = [[parts[-1], -1]], [[parts[0], -1]]
            ends: list[list[int]] = [[], []]
            while len(parts) > 1:
                rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                if rank == 1 << 60:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                if i == len(parts) - 1:
                    ends[0].append(rank)
                    right.append([parts[-1], rank])
                if i == 0:
                    ends[1].append(rank)
                    left.append([parts[0], rank])
            if len(parts) > 1:
                got = [], []
            else:
                got = tuple([(p, r, e) for (p, r), e in zip(x, [*end, 1 << 60], strict=True)] for x, end in zip((right, left), ends, strict=True))
            self.edges[token] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the joined bytes of tokens a and b gives them back (a < 0: b at the start of a piece).

        It doesn't if a part at the right edge of a and one at the left edge of b stand at the same time and their pair
        comes before the merge that ends either; of equal ranks the one further left comes first.
        """
        if a < 0:
            return bool(self._edges(b)[0])
        if (ok := self.follows.get((a, b))) is None:
            if len(self.follows) > 5 * self.most:
                self.follows.clear()
            right, left = self._edges(a)[0], self._edges(b)[1]
            ok = bool(left)
            get = self.ranks.get
            if ok:
                for x, x_from, x_to in right:
                    for y, y_from, y_to in left:
                        if y_from >= x_to:
                            break
                        if y_to > x_from and (r := get(x + y)) is not None and r < x_to and r <= y_to:
                            ok = False
                            break
                    if not ok:
                        break
            self.follows[a, b] = ok
        return ok

    def _state(self, key: tuple) -> int:
        if (n := self.number.get(key)) is None:
            n = self.number[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.last.append(next(pending for pending, part in key[1] if part == b""))
        return n

    def _move(self, state: int, byte: bytes) -> tuple[int, tuple[int, ...]]:
        before, hyps = self.states[state]
        new = []
        prefix, follows = self.prefix, self.follows
        for pending, part in hyps:
            part += byte
            if (at := prefix.get(part)) is None:
                continue
            t, more = at
            if more:
                new.append((pending, part))
            if t >= 0:
                a = pending[-1] if pending else before
                ok = follows.get((a, t))
                if self.may_follow(a, t) if ok is None else ok:
                    new.append(((*pending, t), b""))
        first = new[0][0]
        if len(new) == 1:
            n = len(first)
        else:
            n, most = 0, len(first)
            for p, _ in new:
                if len(p) < most:
                    most = len(p)
            while n < most and all(p[n] == first[n] for p, _ in new):
                n += 1
        emitted = first[:n]
        key = (first[n - 1], tuple([(p[n:], q) for p, q in new])) if n else (before, tuple(new))
        move = self.moves[state][byte[0]] = (self._state(key), emitted)
        return move

    def _rest(self, state: int, piece: bytes, at: int) -> list[int]:
        """What is left to emit when the piece goes on from byte `at`: all hypotheses are followed, but no states made."""
        before, hyps = self.states[state]
        prefix, ranks, follows = self.prefix, self.ranks, self.follows
        out: list[int] = []
        for j in range(at, len(piece) - 1):
            byte, new = piece[j : j + 1], []
            for pending, part in hyps:
                part += byte
                if (found := prefix.get(part)) is None:
                    continue
                t, more = found
                if more:
                    new.append((pending, part))
                if t >= 0:
                    a = pending[-1] if pending else before
                    ok = follows.get((a, t))
                    if self.may_follow(a, t) if ok is None else ok:
                        new.append(((*pending, t), b""))
            hyps = new
            if len(new[-1][0]) > 24:
                first, n = new[0][0], 0
                most = min(len(p) for p, _ in new)
                while n < most and all(p[n] == first[n] for p, _ in new):
                    n += 1
                if n:
                    out.extend(first[:n])
                    before, hyps = first[n - 1], [(p[n:], q) for p, q in new]
        for pending, part in hyps:
            if (t := ranks.get(part + piece[-1:])) is not None:
                a = pending[-1] if pending else before
                ok = follows.get((a, t))
                if self.may_follow(a, t) if ok is None else ok:
                    out.extend(pending)
                    out.append(t)
                    return out
        raise ValueError("no token for a byte")

    def encode(self, piece: bytes) -> list[int]:
        """A transition is kept when it is needed for the second time; most pieces end in ones that never are."""
        if not piece:
            return []
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(self.states) > self.most or len(self.seen) > 5 * self.most:
            self.reset()
        out: list[int] = []
        state, moves = 0, self.moves
        for i, b in enumerate(piece[:-1]):
            move = moves[state].get(b)
            if move is None:
                key = state << 8 | b
                if key not in self.seen:
                    self.seen.add(key)
                    return out + self._rest(state, piece, i)
                move = self._move(state, bytes((b,)))
            state = move[0]
            if move[1]:
                out += move[1]
        end = moves[state].get(piece[-1])
        if end is None:
            return out + self._rest(state, piece, len(piece) - 1)
        return [*out, *end[1], *self.last[end[0]]]


class Utf8Machine:
    """States: 0 between characters; 1-3 that many continuation bytes to come; 4-7 after E0, ED, F0, F4, whose next byte is restricted."""

    ACCEPT = 0

    @staticmethod
    def step(state: int, b: int) -> int:
        """The state after byte b; -1 if b can't stand there."""
        if state == 0:
            if b < 0x80:
                return 0
            if 0xC2 <= b <= 0xDF:
                return 1
            if 0xE0 <= b <= 0xEF:
                return {0xE0: 4, 0xED: 5}.get(b, 2)
            if 0xF0 <= b <= 0xF4:
                return {0xF0: 6, 0xF4: 7}.get(b, 3)
            return -1
        low, high = {4: (0xA0, 0xBF), 5: (0x80, 0x9F), 6: (0x90, 0xBF), 7: (0x80, 0x8F)}.get(state, (0x80, 0xBF))
        if not low <= b <= high:
            return -1
        return {1: 0, 2: 1, 3: 2, 4: 1, 5: 1, 6: 2, 7: 2}[state]


class StreamDecoder:
    """Token ids to bytes in whole characters; feed() as often as needed, then finish()."""

    def __init__(self, names: list[bytes]):
        self.names = names
        self.after: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        self.closed = np.array([self._walk(0, x)[::2] == (0, 0) for x in names])
        self.clear()

    def clear(self) -> None:
        self.state, self.held, self.invalid = 0, b"", 0

    @staticmethod
    def _walk(state: int, token: bytes) -> tuple[int, int, int]:
        """State after the token, bytes of it that belong to an unfinished character, bytes that are invalid."""
        s, open_, bad = state, 0, 0
        for b in token:
            n = Utf8Machine.step(s, b)
            if n < 0:
                bad += 1
                n, open_ = max(0, Utf8Machine.step(0, b)), 0
                open_ = 1 if n else 0
            else:
                open_ = 0 if n == 0 else open_ + 1
            s = n
        return s, open_, bad

    def _run(self, state: int, token: bytes) -> tuple[int, int, int]:
        """The same, kept."""
        if (got := self.after.get((state, token))) is None:
            got = self.after[state, token] = self._walk(state, token)
        return got

    def feed(self, ids: np.ndarray) -> bytes:
        names, many = self.names, ids.tolist()
        # Between characters, tokens of whole characters go through as they are, up to the next one that isn't.
        opening = [*np.flatnonzero(~self.closed[ids]).tolist(), len(many)]
        out, i, k = [], 0, 0
        while i < len(many):
            if self.state == 0 and not self.held:
                while opening[k] < i:
                    k += 1
                if opening[k] > i:
                    out.append(b"".join(map(names.__getitem__, many[i : opening[k]])))
                    i = opening[k]
                    continue
            token = names[many[i]]
            i += 1
            before = self.state
            self.state, open_, bad = self._run(before, token)
            self.invalid += bad
            if open_ == 0:
                out.append(self.held + token if self.held else token)
                self.held = b""
            elif open_ == len(token) and (before or not self.held) and bad == 0:
                self.held += token
            else:
                out.append(self.held + token[: len(token) - open_])
                self.held = token[len(token) - open_ :]
        return b"".join(out)

    def finish(self) -> bytes:
        """What is left of an unfinished character, as it is."""
        rest = self.held
        self.invalid += bool(rest)
        invalid = self.invalid
        self.clear()
        self.invalid_total = invalid
        return rest


class Codec:
    """Encode texts piece by piece (each distinct piece goes through the transducer once while it is kept) and decode ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, states: int = STATES, keep_bytes: int = PIECES):
        import public_tokenizers
        import regex

        self.split = regex.compile(piece_pattern(pattern)).findall
        self.transducer = Transducer(ranks, states)
        names = [b""] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            names[r] = b
        self.decoder = StreamDecoder(names)
        self.decimal = [str(i) for i in range(len(names))]
        # Array operations know one pattern; texts go through the general one for any other.
        self.encode_all = pieces.PieceEncoder(self._pieces, self._texts, keep_bytes=keep_bytes).encode if pattern == public_tokenizers.PATTERN else self._texts

    def _pieces(self, new: list[str]) -> list[list[int]]:
        return [self.transducer.encode(p.encode()) for p in new]

    def _texts(self, texts: list[str]) -> list[np.ndarray]:
        seen: dict[str, list[int]] = {}
        out = []
        for x in texts:
            ids: list[int] = []
            for p in self.split(x):
                if (got := seen.get(p)) is None:
                    got = seen[p] = self.transducer.encode(p.encode())
                ids += got
            out.append(np.array(ids, "<u4"))
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray, chunk: int = 65_536) -> bytes:
        self.decoder.clear()
        parts = [self.decoder.feed(ids[i : i + chunk]) for i in range(0, len(ids), chunk)]
        return b"".join([*parts, self.decoder.finish()])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, states: int = STATES, keep_bytes: int = PIECES) -> Codec:
    return Codec(load_ranks(path), pattern, states, keep_bytes)


def _digest(c: Codec, ids: np.ndarray) -> tuple[str, str]:
    """SHA-256 of the decimal ids, joined by commas, and of the bytes that they decode to."""
    joined = ",".join(map(c.decimal.__getitem__, ids.tolist()))
    return hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()


def _digests(c: Codec, texts: list[str]):
    for ids in c.encode_all(texts):
        yield len(ids), *_digest(c, ids)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False, keep: bool = True) -> DataFrame:
    """doc_id, n_tokens and ids (array<int>) of every row; with digests also ids_sha256 and decoded_sha256, of the ids decoded again.

    Workers keep what they have learned of pieces from task to task; with keep=False they keep less of it and let go of it
    at a task's end, which leaves their memory to the other stages in the same workers."""
    rows = common.pick(docs, doc_id=id_col, text=text_col)
    more = ["ids_sha256", "decoded_sha256"] if digests else []

    def run(batches):
        c = codec(path, pattern) if keep else codec(path, pattern, FEW_STATES, FEW_PIECES)
        for batch in batches:
            for part in common.slices(batch, most=1 << 20 if keep else 1 << 18):
                got = c.encode_all([x or "" for x in part.column(1).to_pylist()])
                size = np.array([len(x) for x in got], np.int64)
                flat = np.concatenate([*got, np.zeros(0, "<u4")]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat))
                cols = [part.column(0), pa.array(size), ids]
                if digests:
                    cols += [pa.array(x) for x in zip(*(_digest(c, x) for x in got), strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids", *more])
        if not keep:
            del c
            codec.cache_clear()
            common.release()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>" + "".join(f", {x} string" for x in more))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); bytes that aren't UTF-8 become U+FFFD."""
    rows = encoded.select("doc_id", "ids")

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            got = [c.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, of ids that were encoded and then decoded again."""
    rows = common.pick(docs, doc_id=id_col, text=text_col)

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for part in common.slices(batch, most=1 << 20):
                n, a, b = zip(*_digests(c, [x or "" for x in part.column(1).to_pylist()]), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4 over the whole of documents."""
    import public_tokenizers as P

    return round_trip(common.table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
