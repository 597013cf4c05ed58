"""Operator 9: secrets in texts, found through a trigram index, in DataFrame functions only.

1. Each rule's regular expression is turned into a Boolean query over trigrams that any match must contain: an OR of ANDs.
2. The index holds a posting (trigram, document) for each trigram that some rule asks for and each lower-cased text that contains it.
3. A rule's candidates are the intersection of the postings of one of its ANDs.
4. Candidates are verified with the expression itself.  Rules without a mandatory trigram scan all texts.

Positions come from the lengths (in code points) of the matches and of the pieces of text between them.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import join_ids, read_table, stored

#: Strings that a part of an expression may stand for, up to which they are listed.
MOST_STRINGS = 64
#: Trigrams in one 64-bit mask.
MASK_BITS = 62
#: Matches whose places are summed up at a time.
STEPS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  #: for Java, Python and RE2 alike
    ignore_case: bool = False
    #: Group whose length decides, and its least length (matches below it are dropped but use up their text).
    group: int = 0
    least: int = 1


#: The base rules, in the order of their kinds.  A run of 24 or more hex digits starts where the run starts and so does
#: an access key, so their least lengths stand in the expression.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", ignore_case=True, group=2, least=6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Rules that add spans.
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repository", "gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + ADDED

Query = frozenset  #: of ANDs, each a frozenset of trigrams; an empty AND is always true


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _least(ands) -> Query:
    """The ANDs that contain no other one."""
    return frozenset(a for a in ands if not any(b < a for b in ands))


def _all_of(x: Query, y: Query) -> Query:
    return _least({a | b for a in x for b in y})


TRUE: Query = frozenset([frozenset()])


def _strings(op, arg) -> set[str] | None:
    """The strings that a node stands for, if they can be listed."""
    if op is sre.LITERAL:
        return {chr(arg)}
    if op is sre.IN:
        out: set[str] = set()
        for kind, v in arg:
            if kind is sre.LITERAL:
                out.add(chr(v))
            elif kind is sre.RANGE and v[1] - v[0] < MOST_STRINGS:
                out |= {chr(c) for c in range(v[0], v[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is sre.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is sre.MAX_REPEAT and arg[1] <= 1:
        inner = _sequence_strings(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes) -> Query:
    """Trigrams needed by a sequence: those of each stretch whose strings can be listed, and of the parts in between."""
    found, stretch = TRUE, {""}

    def close() -> Query:
        return _all_of(found, _least({_trigrams(s) for s in stretch}))

    for op, arg in nodes:
        more = _strings(op, arg)
        if more is not None and len(stretch) * len(more) <= MOST_STRINGS:
            stretch = {a + b for a in stretch for b in more}
            continue
        found, stretch = close(), {""}
        if more is not None:
            stretch = more
        elif op is sre.SUBPATTERN:
            found = _all_of(found, _query(arg[3]))
        elif op is sre.BRANCH:
            found = _all_of(found, _least({a for x in arg[1] for a in _query(x)}))
        elif op is sre.MAX_REPEAT and arg[0] >= 1:
            found = _all_of(found, _query(arg[2]))
    return close()


def trigram_query(pattern: str) -> Query:
    """An OR of ANDs of lower-case trigrams, one of which the lower-cased text of any match contains."""
    return _query(sre_parse.parse(pattern.lower() if "\\" not in pattern.replace("\\x20", "") else pattern))


def _java(rule: Rule) -> str:
    return f"(?i){rule.pattern}" if rule.ignore_case else rule.pattern


def _let(value: Column, body) -> Column:
    """``body`` of a value that is made once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _walk(steps: Column, rule: Rule, number: int) -> Column:
    """Spans of matches from their lengths and the gaps before them.

    Running sums go over blocks of ``STEPS`` matches and then within each, so the arrays that grow by a step at a time stay short.
    """
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(steps) / STEPS).cast("int") - 1), lambda b: F.slice(steps, b * STEPS + 1, F.lit(STEPS)))

    def starts(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, x: n + x["gap"] + x["own"]))
        none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts"))
        return F.aggregate(sizes, none, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")))["starts"]

    def within(block: Column, first: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start, end = acc["at"] + x["gap"], acc["at"] + x["gap"] + x["own"]
            span = F.struct(start.alias("start"), F.lit(number).alias("no"), end.alias("end"), F.lit(rule.kind).alias("kind"))
            return F.struct(end.alias("at"), F.when(x["size"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(block, F.struct(first.alias("at"), _no_spans().alias("spans")), step)["spans"]

    return _let(blocks, lambda bs: F.flatten(F.zip_with(bs, starts(bs), within)))


def _matches(text: Column, rule: Rule, number: int) -> Column:
    """Spans of a rule as structs (start, kind number, end, kind), in code points."""
    pattern = F.lit(_java(rule))

    def steps(found: Column) -> Column:
        own = F.transform(found, F.length)
        size = own if rule.group == 0 else F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
        gap = F.transform(F.slice(F.split(text, _java(rule), -1), F.lit(1), F.size(found)), F.length)
        zipped = F.arrays_zip(own.alias("own"), size.alias("size"), gap.alias("gap"))
        return F.transform(zipped, lambda x: F.struct(x["own"].alias("own"), x["size"].alias("size"), x["gap"].alias("gap")))

    spans = _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: _let(steps(found), lambda s: _walk(s, rule, number)))
    return F.when(text.rlike(_java(rule)), spans).otherwise(_no_spans())


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<start:int,no:int,end:int,kind:string>>)")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame, dict[int, Query]]:
    """``scan_id, rules`` (bit k: rule k may match) of the documents in the intersected postings; the queries of the indexed rules."""
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern)) and frozenset() not in q}
    wanted = sorted({t for q in queries.values() for a in q for t in a})
    number = {t: i for i, t in enumerate(wanted)}
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for t, i in number.items()))) if wanted else F.expr("cast(array() as array<int>)")
    # The lowered text comes out of a generator, else each trigram would lower it anew.
    lowered = docs.select("scan_id", F.explode(F.array(F.lower("text"))).alias("low"))
    postings = lowered.select("scan_id", F.explode(held).alias("trigram")).distinct()
    words = range(-(-max(1, len(wanted)) // MASK_BITS))
    masks = postings.groupBy("scan_id").agg(
        *(F.bit_or(F.expr(f"case when trigram div {MASK_BITS} = {w} then shiftleft(1L, cast(trigram % {MASK_BITS} as int)) else 0L end")).alias(f"m{w}") for w in words)
    )

    def meets(query: Query) -> Column:
        out = F.lit(False)
        for needed in sorted(map(sorted, query)):
            one = F.lit(True)
            for w in words:
                bits = sum(1 << number[t] % MASK_BITS for t in needed if number[t] // MASK_BITS == w)
                one &= F.col(f"m{w}").bitwiseAND(F.lit(bits).cast("long")) == bits
            out |= one
        return out

    flags = F.lit(0)
    for k, q in queries.items():
        flags = flags.bitwiseOR(F.when(meets(q), F.lit(1 << k)).otherwise(0))
    return masks.select("scan_id", flags.alias("rules")).where("rules <> 0"), queries


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, n_base: int = len(BASE)) -> DataFrame:
    """``doc_id``, ``n_<kind>`` of the first ``n_base`` rules, ``base_sha256`` and ``spans`` for each row of ``docs (doc_id, text)``.

    ``spans`` has ``kind:start:end`` (code points, end exclusive) of all rules by start, then rule, joined by commas; the hash is
    of the same string for the base rules alone.  A null text counts as empty.  Rows that repeat an id, or have none,
    are scanned each for itself (candidates are kept by id: a text may be scanned for its namesake's sake); other columns are ignored.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("scan_id"))
    found, queries = candidates(rows, rules)
    marked = join_ids(rows, stored(found, "candidates"), "scan_id", "left")
    # Each kind's spans are their own column, so that an expression is looked for only where its rule may match.
    for k, r in enumerate(rules):
        may = F.coalesce(F.col("rules"), F.lit(0)).bitwiseAND(1 << k) != 0 if k in queries else F.lit(True)
        marked = marked.withColumn(f"s{k}", F.when(may, _matches(F.col("text"), r, k)).otherwise(_no_spans()))
    base = F.concat(*(F.col(f"s{k}") for k in range(n_base)))
    every = F.concat(*(F.col(f"s{k}") for k in range(len(rules))))
    return marked.select(
        "doc_id",
        *(F.size(f"s{k}").cast("long").alias(f"n_{rules[k].kind}") for k in range(n_base)),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(every).alias("spans"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def _duckdb(rules: tuple[Rule, ...] = RULES, n_base: int = len(BASE)) -> str:
    parts = []
    for k, r in enumerate(rules):
        p = ("(?i)" if r.ignore_case else "") + r.pattern.replace("'", "''")
        if r.ignore_case:  # RE2 folds two letters beyond ASCII on s and k: spell the cases out instead
            word = r.pattern[: r.pattern.index(")")]
            p = ("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) + r.pattern[len(word) :]).replace("'", "''")
        parts.append(
            f"""SELECT doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'a': coalesce(list_sum(list_transform(b[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0), 'k': {k}, 'n': length(m[i]), 'g': length(g[i]), 'kind': '{r.kind}'}}), lambda s: s.g >= {r.least}) AS s
  FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS g, string_split_regex(t, '{p}') AS b FROM d)"""
        )
    write = "coalesce(string_agg(s.kind || ':' || CAST(s.a AS BIGINT) || ':' || CAST(s.a + s.n AS BIGINT), ',' ORDER BY s.a, s.k){f}, '')"
    base = write.replace("{f}", f" FILTER (s.k < {n_base})")
    counts = ", ".join(f"count(*) FILTER (s.k = {k}) AS n_{rules[k].kind}" for k in range(n_base))
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
each_kind AS ({" UNION ALL ".join(parts)}),
found AS (SELECT doc_id, unnest(s) AS s FROM each_kind)
SELECT d.doc_id, {counts}, sha256({base}) AS base_sha256, {write.replace("{f}", "")} AS spans
FROM d LEFT JOIN found ON found.doc_id = d.doc_id GROUP BY d.doc_id"""


ORACLE = _duckdb()
