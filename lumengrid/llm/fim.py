"""Fill-in-the-middle: a text is cut into prefix, middle and suffix at unit boundaries and put together in another order.

One Aho-Corasick automaton runs over a text and reports its events: the ASCII characters at which the class of text changes
(none for units of one character) and the sentinels. Between two events nothing has to be looked at: the gap's length says
how many units it holds. Of the unit ends only every step-th is kept, MARKS at most (step doubles as they fill up), so a
text of newlines takes no more memory than prose; the end of unit k is found by scanning on from the mark before it.

Units: "line" `[^\\n]*\\n|[^\\n]+`; "word" `[\\x20\\t-\\r]*[^\\x20\\t-\\r]+|[\\x20\\t-\\r]+`; "char" one code point.

A document's draws are the first four 8-digit groups of the hex SHA-256 of `seed:doc_id`, so they don't hang on partitions,
order or retries. Texts that are empty or hold a sentinel stay plain, as does the share of others that `rate` leaves.

Edge cases: null text counts as empty (n 0, plain); a null id draws as the empty string does; repeated rows are kept and
come out alike, one output row for each input row; an empty table gives an empty one; other columns come back as keep_<name>
where asked for, under whatever name they clash. Texts are read whole; a task holds some MB of them at a time.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SENTINELS = ("<P>", "<S>", "<M>")
BREAKS = {"line": "\n", "word": " \t\n\v\f\r", "char": ""}
#: Unit ends kept of a text.
MARKS = 4096
_BREAK, _SENTINEL = 0, 1


def automaton(unit: str, sentinels: tuple[str, ...]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for s in sentinels:
        a.add_word(s, _SENTINEL)
    for c in BREAKS[unit]:
        a.add_word(c, _BREAK)
    a.make_automaton()
    return a


class Units:
    """The units of a text (`n` of them), where they end, and whether it holds a sentinel (`marked`)."""

    def __init__(self, a: ahocorasick.Automaton, text: str, unit: str):
        self.a, self.text, self.unit = a, text, unit
        self.n, self.step, self.marks, self.marked = 0, 1, [0], False
        for end in self._ends(0):
            self.n += 1
            if self.n % self.step == 0:
                self.marks.append(end)
                if len(self.marks) > MARKS:
                    self.marks, self.step = self.marks[::2], self.step * 2
        if unit == "char":
            self.n = len(text)

    def _ends(self, start: int):
        """Ends of units from `start` on, which is an end itself."""
        last, done = start - 1, start  # the event before, the last end
        for at, kind in self.a.iter(self.text, start):
            if kind == _SENTINEL:
                self.marked = True
                continue
            if self.unit == "line":
                yield (done := at + 1)
            elif at - last > 1:  # characters of a word lie in the gap
                yield (done := at)
            last = at
        if done < len(self.text) and self.unit != "char":
            yield len(self.text)

    def end(self, k: int) -> int:
        """Code points of the first k units."""
        if k == self.n or self.unit == "char":
            return len(self.text) if k == self.n else k
        at, rest = self.marks[k // self.step], k % self.step
        for _, at in zip(range(rest), self._ends(at)):
            pass
        return at


def arrange(text: str, key: str, a: ahocorasick.Automaton, unit: str, seed: str, rate: int, spm: int, sentinels: tuple[str, str, str]):
    """(n, form, characters of the prefix and of the middle, output) of one text."""
    units = Units(a, text, unit)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or units.marked or h3 % 100 >= rate:
        return units.n, "plain", None, None, text
    one, two = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    i, j = units.end(one), units.end(two)
    pre, suf, mid = sentinels
    if h4 % 100 < spm:
        return units.n, "spm", i, j - i, "".join((suf, text[j:], pre, text[:i], mid, text[i:j]))
    return units.n, "psm", i, j - i, "".join((pre, text[:i], suf, text[j:], mid, text[i:j]))


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", seed: str = "7", rate: int = 100, spm: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of docs: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain), output, and keep_<name>.

    rate: of a hundred texts those transformed; spm: of a hundred of these those with the suffix first. A sentinel must not be empty."""
    if len(sentinels) != 3 or not all(sentinels) or len(set(sentinels)) != 3:
        raise ValueError("three different sentinels are needed")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("key"), text.alias("text"), *[F.col(f"`{c}`").alias(f"keep_{c}") for c in keep])
    others = rows.schema.fields[3:]

    def run(batches):
        a = automaton(unit, sentinels)
        for batch in batches:
            for part in common.slices(batch):
                got = [arrange(x, k, a, unit, seed, rate, spm, sentinels) for x, k in zip(part.column(2).to_pylist(), part.column(1).to_pylist(), strict=True)]
                n, form, pre, mid, out = zip(*got, strict=True)
                made = [pa.array(n, pa.int64()), pa.array(form), pa.array(pre, pa.int64()), pa.array(mid, pa.int64()), pa.array(out)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made, *part.columns[3:]], names=names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", *[f.name for f in others]]
    types = [rows.schema["doc_id"].dataType.simpleString(), "bigint", "string", "bigint", "bigint", "string", *[f.dataType.simpleString() for f in others]]
    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True)))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of."""
    pre, suf, mid = sentinels
    middle = F.substring_index(output, mid, -1)
    head = F.substring_index(output, mid, 1)

    def between(first: str, then: str) -> tuple[Column, Column]:
        return F.substr(F.substring_index(head, then, 1), F.lit(len(first) + 1)), F.substring_index(head, then, -1)

    p, s = between(pre, suf)
    s2, p2 = between(suf, pre)
    return F.when(form == "psm", F.concat(p, middle, s)).when(form == "spm", F.concat(p2, middle, s2)).otherwise(output)


ORACLE = """with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
u as (select *, length(t) - length(replace(t, chr(10), '')) + (t <> '' and not ends_with(t, chr(10)))::int as n, string_split(t, chr(10)) as l from d),
c as (select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as c1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as c2,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 100 then 'plain'
    when ('0x' || substr(h, 25, 8))::bigint % 100 < 50 then 'spm' else 'psm' end as form from u),
e as (select *, case when least(c1, c2) = n then t when least(c1, c2) = 0 then '' else array_to_string(l[1:least(c1, c2)], chr(10)) || chr(10) end as p,
    case when greatest(c1, c2) = n then t when greatest(c1, c2) = 0 then '' else array_to_string(l[1:greatest(c1, c2)], chr(10)) || chr(10) end as pm from c),
o as (select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(pm) - length(p) end as middle_chars,
    case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || substr(t, length(pm) + 1) || '<M>' || substr(pm, length(p) + 1)
    else '<S>' || substr(t, length(pm) + 1) || '<P>' || p || '<M>' || substr(pm, length(p) + 1) end as o from e),
r as (select *, string_split(string_split(o, '<M>')[1], case form when 'psm' then '<S>' else '<P>' end) as two from o)
select doc_id, n::bigint as n, form, prefix_chars::bigint as prefix_chars, middle_chars::bigint as middle_chars, sha256(o) as output_sha256,
    sha256(case form when 'plain' then o when 'psm' then substr(two[1], 4) || string_split(o, '<M>')[2] || two[2] else two[2] || string_split(o, '<M>')[2] || substr(two[1], 4) end) as restored_sha256
from r"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12 over the whole of documents: digests of the outputs and of the texts rebuilt from them."""
    made = transform(common.table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))
