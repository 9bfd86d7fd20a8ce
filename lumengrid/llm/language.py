"""Language identification by cross-parsing entropy.

From labelled text of each language a suffix automaton is built. A text is parsed against each automaton into the longest
phrases that occur in that language's text; the language that needs the fewest phrases per character wins. Text is parsed
in segments of SEGMENT code points (a phrase ends with its segment, for every language alike), so that many segments move
through the automata together, with one array operation for each character of a segment. White space runs count as one
space, digits and other characters without a letter as one class; letters are lower-cased, those beyond the basic plane one class.

Fitting takes a bounded sample: for each language the ROWS labelled documents with the smallest hashes of their text, and
of each a window of WINDOW code points at a hashed place (the whole text where it is shorter). Prediction reads whole texts.

Edge cases: null text or text without a letter: `und`, score 0; ties go to the first language in sorted order; with no
labelled text at all every document is `und`; labels that are null are not learned from; null ids and repeated rows are
kept; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

ROWS, WINDOW, SEGMENT, SALTS = 100, 600, 256, 16
UNKNOWN = "und"


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton that accepts every substring of codes; state 0 is its start."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def _class_table() -> np.ndarray:
    """For each code point of the basic plane: itself lower-cased if a letter, space for white space, '#' for others."""
    out = np.full(1 << 16, ord("#"), np.uint16)
    for c in range(1 << 16):
        x = chr(c)
        if x.isspace():
            out[c] = 32
        elif x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return out


_TABLE: list[np.ndarray] = []


def normal(codes: np.ndarray) -> np.ndarray:
    """Code points to classes, with runs of spaces and runs of '#' as one."""
    if not _TABLE:
        _TABLE.append(_class_table())
    out = _TABLE[0][np.minimum(codes, (1 << 16) - 1)]
    astral = codes >= 1 << 16
    if astral.any():  # letters beyond the basic plane are one class, others are like its others
        distinct, back = np.unique(codes[astral], return_inverse=True)
        out[astral] = np.array([0xFFFD if chr(c).isalpha() else ord("#") for c in distinct.tolist()], np.uint16)[back]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | ((out[1:] != 32) & (out[1:] != 35))
    return out[keep]


def has_letter(classes: np.ndarray) -> bool:
    return bool(((classes != 32) & (classes != 35)).any())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Moves:
    """The transitions of an automaton, laid over each other: that of state s by symbol c is in slot base[s] + c, if the slot says that it is the state's
    (`of`), else there is none. Some ten bytes a transition whatever the alphabet, and few enough for a processor's cache."""

    #: Places that are tried for a state before it goes to the end.
    TRIES = 40

    def __init__(self, auto: list[dict[int, int]], width: int):
        rows = [[c for c in on if c] for on in auto]  # symbol 0 leads nowhere
        used = bytearray(width)
        base = np.zeros(max(len(auto), 1), np.int64)
        first = 0
        for s in sorted((s for s, cs in enumerate(rows) if len(cs) > 1), key=lambda s: -len(rows[s])):
            cs, low = rows[s], min(rows[s])
            p = first
            for k in range(self.TRIES):
                if k == self.TRIES // 2:  # the front is full by and large: elsewhere
                    p = s * 0x9E3779B1 % len(used)
                p = used.find(0, p)
                if p < 0:
                    break
                if p >= low and not any(used[p - low + c] for c in cs if p - low + c < len(used)):
                    break
                p += 1
            else:
                p = -1
            if k >= self.TRIES // 2:
                first = max(0, used.find(0, first + 1))
            at = (p if p >= 0 else len(used)) - low
            top = at + max(cs)
            if top >= len(used):
                used.extend(bytes(top + 1 - len(used)))
            for c in cs:
                used[at + c] = 1
            base[s] = at
        single = np.array([s for s, cs in enumerate(rows) if len(cs) == 1], np.int64)
        symbol = np.array([rows[s][0] for s in single.tolist()], np.int64)
        free = np.flatnonzero(np.frombuffer(bytes(used), np.uint8) == 0)
        free = free[free >= width][: len(single)]
        slots = np.concatenate([free, np.arange(len(used), len(used) + len(single) - len(free))])
        base[single] = slots - symbol
        size = max(len(used), int(slots.max(initial=-1)) + 1) + width
        self.base, self.of, self.to = base, np.full(size, -1, np.int32), np.zeros(size, np.int32)
        each = np.array([(s, c, auto[s][c]) for s, cs in enumerate(rows) for c in cs], np.int64).reshape(-1, 3)
        at = base[each[:, 0]] + each[:, 1]
        self.of[at], self.to[at] = each[:, 0], each[:, 2]
        self.root = self(np.zeros(width, np.int64), np.arange(width))

    def __call__(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The next states, 0 if there are none."""
        at = self.base[state] + c
        return self.to[at] * (self.of[at] == state)


@dataclass
class Model:
    """langs: in sorted order; symbol: class to number (0: never seen), below width; moves: for each language its automaton."""

    langs: list[str]
    symbol: np.ndarray
    width: int
    moves: list[Moves]


def fit_texts(texts: dict[str, list[str]]) -> Model:
    """Automata of the languages' texts."""
    langs = sorted(texts)
    joined = {}
    for lang in langs:
        parts = []
        for x in texts[lang]:
            c = normal(code_points(x))
            if len(c) and has_letter(c):
                parts += [c, np.array([0], np.uint16)]  # nothing runs on from one document into the next
        joined[lang] = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
    used = np.unique(np.concatenate([*joined.values(), np.zeros(0, np.uint16)])) if joined else np.zeros(0, np.uint16)
    used = used[used != 0]
    symbol = np.zeros(1 << 16, np.int32)
    symbol[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    moves = []
    for lang in langs:
        # Number 0 stands for separators here and for unseen characters in parsing; its transitions are dropped.
        moves.append(Moves(suffix_automaton(symbol[joined[lang]].tolist()), width))
    return Model(langs, symbol, width, moves)


def phrases(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases of each text (rows) in each language (columns); texts as classes."""
    size = np.array([len(x) for x in texts], np.int64)
    count = -(-size // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), count)
    out = np.zeros((len(texts), len(model.langs)), np.int64)
    if not len(owner):
        return out
    rows = np.zeros((len(owner), SEGMENT), np.int32)
    place = (np.cumsum(count) - count) * SEGMENT
    flat = rows.ravel()
    body = model.symbol[np.concatenate(texts)]
    flat[np.repeat(place - (np.cumsum(size) - size), size) + np.arange(len(body))] = body
    length = np.minimum(SEGMENT, np.repeat(size, count) - (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * SEGMENT)
    order = np.argsort(-length, kind="stable")
    cols = np.ascontiguousarray(rows[order].T)
    alive = np.searchsorted(-length[order], -np.arange(SEGMENT), side="left")  # segments longer than the step
    for k, moved in enumerate(model.moves):
        state = np.zeros(len(owner), np.int64)
        made = np.ones(len(owner), np.int64)  # the first phrase of a segment
        for step in range(SEGMENT):
            n = int(alive[step])
            if not n:
                break
            c = cols[step, :n]
            s = moved(state[:n], c)
            # No way on: a new phrase starts with this character. A character that the language does not have at all is
            # a phrase of its own (state 0 after it), so what follows starts another one.
            stuck = np.flatnonzero(s == 0)
            if step:
                made[:n] += (s == 0) | (state[:n] == 0)
            if len(stuck):
                s[stuck] = moved.root[c[stuck]]
            state[:n] = s
        np.add.at(out[:, k], owner[order], made)
    return out


def _hash_mod(id_col: Column, mod: int) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(mod))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, window: int = WINDOW) -> Model:
    """Fit on the given labelled rows; see the module's text for the sample."""
    d = common.pick(docs, doc_id=id_col, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    keys = d.select("lang", F.xxhash64("text").alias("h")).distinct()
    # Ranks within a language and salt first, then within the language over at most SALTS times `rows`.
    salted = Window.partitionBy("lang", F.pmod("h", F.lit(SALTS))).orderBy("h")
    some = keys.withColumn("r", F.row_number().over(salted)).where(f"r <= {rows}")
    best = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(f"r <= {rows}").select("lang", "h").collect()
    # At most `rows` hashes for each language, broadcast.
    want = docs.sparkSession.createDataFrame([(r[0], r[1]) for r in best], "lang string, h long")
    found = d.withColumn("h", F.xxhash64("text")).join(F.broadcast(want), ["lang", "h"])
    place = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - window, F.lit(0)) + 1) + 1
    kept = found.groupBy("lang", "h").agg(F.min(F.substring(F.col("text"), place.cast("int"), F.lit(window))).alias("text")).orderBy("lang", "h").collect()
    texts: dict[str, list[str]] = {}
    for r in kept:
        texts.setdefault(r["lang"], []).append(r["text"])
    return fit_texts(texts)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, text, the columns of keep (as keep_<name>, so that none clashes), lang_pred, score. The score is 1 for the certain, and near 0 where the
    two best languages need equally many phrases: 1 - (fewest phrases / second fewest), scaled by 4 and cut at 1."""
    spark = docs.sparkSession
    # For each language three moves at most for each character of ROWS windows, and a slot of 8 bytes for each and some more.
    held = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"keep_{c}") for c in keep])

    def run(batches):
        m = held.value
        for batch in batches:
            for part in common.slices(batch, most=2 << 20):
                classes = [normal(code_points(x or "")) for x in part.column(1).to_pylist()]
                ok = np.array([has_letter(c) for c in classes], bool) & bool(m.langs)
                n = phrases(m, classes) if m.langs else np.zeros((len(classes), 1), np.int64)
                best = n.argmin(axis=1)
                two = np.sort(n, axis=1)
                second = two[:, 1] if n.shape[1] > 1 else np.array([max(1, len(c)) for c in classes])
                score = np.where(ok, np.clip(4 * (1 - two[:, 0] / np.maximum(second, 1)), 0, 1), 0.0)
                lang = [m.langs[b] if o else UNKNOWN for b, o in zip(best.tolist(), ok.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])
        common.release()

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, held_mod: int = 4, held_is: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fit on the labelled documents that aren't held out, predict all: doc_id, text, keep_<name>..., held_out, lang_pred, score."""
    held_out = _hash_mod(F.col("doc_id"), held_mod) == held_is
    model = fit(docs.where(~F.coalesce(held_out, F.lit(False))))
    return predict(docs, model, keep=keep).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8 over the whole of documents."""
    return identify(common.table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")
