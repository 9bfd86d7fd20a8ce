"""Secret scan through a trigram inverted index; DataFrame functions only.

From each rule's regex a Boolean trigram query is derived (an OR of ANDs of lower-cased trigrams that every match must
hold). The index has one posting (trigram, doc_id) for each trigram of the queries and document. A rule's candidates
are the documents whose postings satisfy its query; only these are verified by the regex. A rule without mandatory
trigrams (runs of hex digits) scans every text.

Edge cases: null text counts as empty; a null doc_id is a key like any other; rows that share a doc_id share its
candidates, and each is verified on its own text; an empty table gives an empty table; other columns are ignored.
Very long texts are scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common


@dataclass(frozen=True)
class Rule:
    """A kind of secret. group/least: matches whose group is shorter than `least` characters are dropped."""

    kind: str
    regex: str
    group: int
    least: int
    base: bool = False


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),  # as [0-9a-f]+ of 16 and more: a match is always the whole run
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}", 0, 1),
)

#: Alternatives of exact strings or of conjunctions beyond which an analysis gives up detail (and keeps a superset).
_MOST = 24


def _trigrams(s: str) -> frozenset[str]:
    s = s.lower()
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _or(a: list[frozenset], b: list[frozenset]) -> list[frozenset]:
    out = {*a, *b}
    return [frozenset()] if frozenset() in out or len(out) > _MOST else sorted(out, key=sorted)


def _and(a: list[frozenset], b: list[frozenset]) -> list[frozenset]:
    out = {x | y for x in a for y in b}
    return sorted(out, key=sorted) if len(out) <= _MOST else min(a, b, key=len)


def trigram_query(regex: str) -> list[frozenset[str]]:
    """OR of ANDs of trigrams that every match must contain (lower-cased); [frozenset()] if there are none."""

    def close(strings: set[str] | None) -> list[frozenset]:
        return [frozenset()] if strings is None else reduce(_or, ([_trigrams(s)] for s in strings), [])

    def sequence(items) -> tuple[set[str] | None, list[frozenset]]:
        """Exact strings that the whole can be (None: not known), and what must hold besides."""
        run: set[str] | None = {""}
        need, whole = [frozenset()], True
        for op, arg in items:
            exact, more = node(op, arg)
            need = _and(need, more)
            if exact is not None and len(run) * len(exact) <= _MOST:
                run = {x + y for x in run for y in exact}
            else:
                # What was exact so far must occur; the next strings start anew.
                need, whole = _and(need, close(run)), False
                run = exact if exact is not None and len(exact) <= _MOST else {""}
        return (run, need) if whole else (None, _and(need, close(run)))

    def node(op, arg) -> tuple[set[str] | None, list[frozenset]]:
        any_ = (None, [frozenset()])
        if op is C.LITERAL:
            return {chr(arg).lower()}, [frozenset()]
        if op is C.IN:
            chars: set[str] = set()
            for kind, x in arg:
                if kind is C.LITERAL:
                    chars.add(chr(x).lower())
                elif kind is C.RANGE and x[1] - x[0] < _MOST:
                    chars |= {chr(i).lower() for i in range(x[0], x[1] + 1)}
                else:
                    return any_
            return (chars, [frozenset()]) if len(chars) <= _MOST else any_
        if op is C.SUBPATTERN:
            return sequence(arg[-1])
        if op is C.BRANCH:
            parts = [sequence(x) for x in arg[1]]
            if all(e is not None for e, _ in parts) and sum(len(e) for e, _ in parts) <= _MOST:
                return set().union(*(e for e, _ in parts)), [frozenset()]
            return None, reduce(_or, (_and(n, close(e)) for e, n in parts), [])
        if op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, what = arg
            exact, need = sequence(what)
            if (low, high) == (0, 1) and exact is not None:
                return exact | {""}, [frozenset()]
            if low == high == 1:
                return exact, need
            return (None, _and(need, close(exact))) if low else any_
        return any_

    exact, need = sequence(parser.parse(regex))
    out = _and(need, close(exact))
    # A conjunction that contains another one adds nothing.
    return [x for x in out if not any(y < x for y in out)]


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams of all queries that have some; their place is their bit in a document's mask."""
    return sorted({t for r in rules for c in trigram_query(r.regex) for t in c})


def _any_of(trigrams: list[str]) -> str:
    """A regex that finds each of the trigrams wherever it starts, group 1; alternatives share what they start with."""
    tree: dict[str, dict[str, list[str]]] = {}
    for t in trigrams:
        tree.setdefault(t[0], {}).setdefault(t[1], []).append(t[2])
    quoted = lambda c: c if c.isalnum() else f"\\x{{{ord(c):x}}}"
    return "(?=(" + "|".join(quoted(a) + "(?:" + "|".join(f"{quoted(b)}[{''.join(map(quoted, cs))}]" for b, cs in more.items()) + ")" for a, more in tree.items()) + "))"


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index: (trigram, doc_id), one row for each trigram of the rules' queries and document that has it.
    It can be kept, and given to scan() again for the same documents."""
    vocab = vocabulary(rules)
    has = F.array_distinct(F.regexp_extract_all(F.lower(F.col("text")), F.lit(_any_of(vocab)), F.lit(1))) if vocab else F.array().cast("array<string>")
    return common.pick(docs, doc_id=id_col, text=text_col).select(F.explode(has).alias("trigram"), "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules): bit i is set where the postings of the document satisfy the query of rule i."""
    vocab = vocabulary(rules)
    place = F.create_map(*[x for i, t in enumerate(vocab) for x in (F.lit(t), F.lit(i))])
    words = -(-len(vocab) // 63)
    bit = lambda w: F.when(F.floor(place[F.col("trigram")] / 63) == w, F.expr("shiftleft(1L, cast(p % 63 as int))"))
    masks = index.withColumn("p", place[F.col("trigram")]).groupBy("doc_id").agg(*[F.bit_or(bit(w)).alias(f"m{w}") for w in range(words)])

    def holds(conj: frozenset[str]) -> Column:
        out = F.lit(True)
        for w in range(words):
            want = sum(1 << (vocab.index(t) % 63) for t in conj if vocab.index(t) // 63 == w)
            if want:
                out &= F.coalesce(F.col(f"m{w}"), F.lit(0)).bitwiseAND(F.lit(want)) == want
        return out

    rule = F.lit(0)
    for i, r in enumerate(rules):
        if frozenset() not in (q := trigram_query(r.regex)):
            rule = rule.bitwiseOR(F.when(reduce(lambda a, b: a | b, [holds(c) for c in q]), F.lit(1 << i)).otherwise(0))
    return masks.select("doc_id", rule.cast("long").alias("rules")).where("rules <> 0")


#: Matches that are placed one after the other; an array grows by copying, so runs of matches are placed by themselves.
RUN = 256


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's matches as array<struct<start, ord, end, kind>>, in code points, end exclusive.

    The pieces between the matches and the matches alternate, so their lengths add up to the offsets: within runs of RUN matches
    from 0, and from run to run.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group)) if rule.group else whole
    lens = F.zip_with(
        F.transform(F.split(text, rule.regex, -1), F.length), F.arrays_zip(F.transform(whole, F.length).alias("w"), F.transform(group, F.length).alias("g")),
        lambda gap, m: F.struct(gap.alias("gap"), m["w"].alias("w"), m["g"].alias("g")),
    )
    kind = "array<struct<start:int,end:int>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["w"], F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["g"] >= rule.least, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def run(part: Column) -> Column:
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)

    def runs(lens: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / RUN).cast("int")), lambda i: run(F.slice(lens, i * RUN + 1, F.lit(RUN))))

    def placed(acc: Column, r: Column) -> Column:
        return F.struct((acc["at"] + r["at"]).alias("at"), F.concat(acc["of"], F.array(F.struct(acc["at"].alias("base"), r["out"].alias("out")))).alias("of"))

    # One-element arrays give a name to what is used more than once, which is then worked out once.
    each = F.flatten(F.transform(F.array(lens), runs))
    based = F.aggregate(each, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<base:int,out:{kind}>>").alias("of")), placed)["of"]
    full = lambda r: F.transform(r["out"], lambda m: F.struct((r["base"] + m["start"]).alias("start"), F.lit(order).alias("ord"), (r["base"] + m["end"]).alias("end"), F.lit(rule.kind).alias("kind")))
    return F.flatten(F.transform(based, full))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), index: DataFrame | None = None) -> DataFrame:
    """Per row of docs: doc_id, text, the columns of `keep` (as keep_<name>, so that none clashes), and found: array of (start, ord, end, kind), by start and rule.
    index: postings() of these documents, if they have been kept. Only ids and rules of candidates are joined with the texts."""
    with common.tables(docs.sparkSession) as kept:
        index = index or common.written(postings(docs, rules, id_col, text_col), "postings")
        cand = common.written(candidates(index, rules).withColumnRenamed("doc_id", "cand_id"), "secret-candidates")
        kept(cand)
    cand = common.bounded(cand)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`").alias(f"keep_{c}") for c in keep])
    both = rows.join(cand, F.col("doc_id").eqNullSafe(F.col("cand_id")), "left")
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    found = []
    for i, r in enumerate(rules):
        text = F.coalesce(F.col("text"), F.lit(""))
        if frozenset() in trigram_query(r.regex):
            may = text.rlike(r.regex)
        else:
            may = (F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0) & text.rlike(r.regex)
        found.append(F.when(may, _spans(text, r, i)).otherwise(empty))
    return both.select("doc_id", "text", *[f"keep_{c}" for c in keep], F.sort_array(F.concat(*found)).alias("found"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3 over the whole of documents."""
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    bases = [r.kind for r in RULES if r.base]
    return scan(common.table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k) for k in bases], F.sha2(_joined(F.filter("found", lambda x: x["kind"].isin(bases))), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans")
    )


def oracle() -> str:
    """DuckDB SQL for query(): every rule on every text, without an index."""
    parts = []
    for i, r in enumerate(RULES):
        rx = r.regex.replace("'", "''")
        parts.append(
            f"""select d.rid, i.i as k, {i} as ord, '{r.kind}' as kind,
       list_sum(list_transform(gaps[1:i.i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i.i - 1], lambda x: length(x))), 0) as s,
       length(whole[i.i]) as n, length(grp[i.i]) as g, {r.least} as least
from (select rid, string_split_regex(t, '{rx}') as gaps, regexp_extract_all(t, '{rx}', 0) as whole, regexp_extract_all(t, '{rx}', {r.group}) as grp from d where regexp_matches(t, '{rx}')) d,
     lateral (select unnest(range(1, len(whole) + 1)) as i) i"""
        )
    bases = ", ".join(f"'{r.kind}'" for r in RULES if r.base)
    counts = ", ".join(f"coalesce(x.n_{r.kind}, 0)::bigint as n_{r.kind}" for r in RULES if r.base)
    sums = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in RULES if r.base)
    one = "kind || ':' || s::bigint || ':' || (s + n)::bigint"
    return f"""with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
m as ({' union all '.join(parts)}),
x as (select rid, {sums}, string_agg({one}, ',' order by s, ord) filter (kind in ({bases})) as b, string_agg({one}, ',' order by s, ord) as a from m where g >= least group by rid)
select d.doc_id, {counts}, sha256(coalesce(x.b, '')) as base_sha256, coalesce(x.a, '') as spans from d left join x using (rid)"""
