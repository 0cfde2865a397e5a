"""Secret scans by a trigram inverted index, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.llm.common import parts_for, spare, text_of
from varve.llm.trigrams import Query, trigram_query
from varve.session import broadcast_if_small, materialize_counted

# Different texts in a block of the index: the bound of one posting list.
BLOCK_TEXTS = 4096
# Values folded one after the other by a running sum or maximum.
FOLDED = 64
SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# A private key goes on to its END line, if no other key begins before that. Where it is missing, the lines
# that follow belong to the key: those of base64 alone, also quoted or with line ends written \n, and the
# two headers of an encrypted key. Possessive and single-step loops need no stack for long texts.
_TO_END = r"(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----"
_LINE_END = r"""[\x20\t"'+,;]*+(?:\r?\n|\r|(?:\\r)?\\n)[\x20\t>#*|"']*+"""
_KEY_LINE = (
    rf"(?:{_LINE_END})++"
    r"""(?:(?:Proc-Type|DEK-Info):(?:(?!\\[rn])[^\r\n])*+|[A-Za-z0-9+/=]++(?=[\x20\t"'+,;]*(?:[\r\n\\]|$)))"""
)

# The three base kinds, then kinds with a published token format.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    # The first part matches alone too, so that a long run without a dot is read once and not from each "eyJ" in it.
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+(\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+|)", group=1),
    Rule("private", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_TO_END}|(?:{_KEY_LINE})*+)"),
)


def _running(values: Column, step) -> Column:
    """For each place of an array of integers, ``step`` (sum or maximum) over all values up to there.

    A fold copies what it has so far, so one over the whole array takes time with its square. This one
    folds pieces of ``FOLDED`` values, then what the pieces come to, in three levels.
    """

    def folded(array: Column) -> Column:
        start = F.slice(array, 1, 1)
        return F.aggregate(
            F.slice(array, 2, F.greatest(F.size(array), F.lit(1))),
            start,
            lambda out, v: F.concat(out, F.array(step(F.element_at(out, -1), v))),
        )

    def level(array: Column, depth: int) -> Column:
        if not depth:
            return folded(array)
        last = F.floor((F.size(array) - 1) / FOLDED).cast("int")
        pieces = F.transform(F.sequence(F.lit(0), last), lambda n: folded(F.slice(array, n * FOLDED + 1, F.lit(FOLDED))))
        return _bound(pieces, lambda cut: _bound(level(F.transform(cut, lambda p: F.element_at(p, -1)), depth - 1), lambda upto: spread(cut, upto)))

    def spread(cut: Column, upto: Column) -> Column:
        shifted = F.transform(cut, lambda p, n: F.when(n == 0, p).otherwise(_bound(F.get(upto, n - 1), lambda u: F.transform(p, lambda v: step(u, v)))))
        return F.flatten(shifted)

    return _bound(values, lambda array: F.when(F.size(array) > 0, level(array, 2)).otherwise(array))


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, rule: Rule) -> Column:
    """Spans of a rule in one text, in code points: array of (start, kind, end).

    What lies between the matches, and the matches, alternate, so their lengths give the places.
    A whole match of fixed least length is searched in that form, which finds the same spans.
    """
    pattern = rule.pattern
    if rule.group == 0 and rule.least > 1 and pattern.endswith("]+") and pattern.startswith("["):
        pattern = f"{pattern[:-1]}{{{rule.least},}}"
    lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    held = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), F.length)
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    kind = [r.kind for r in RULES].index(rule.kind) if rule in RULES else 0

    def placed(lengths: Column) -> Column:
        steps = F.zip_with(lengths, F.slice(gaps, 1, F.size(lengths)), lambda length, gap: length + gap)
        matches = F.arrays_zip(_running(steps, lambda a, b: a + b).alias("end"), lengths.alias("len"), held.alias("held"))
        return F.transform(
            F.filter(matches, lambda m: m["held"] >= rule.least),
            lambda m: F.struct((m["end"] - m["len"]).alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")),
        )

    return F.when(F.regexp_like(text, F.lit(pattern)), _bound(lengths, placed)).otherwise(F.array().cast(SPANS))


def _postings_of(query: Query, postings: Column) -> Column:
    """Texts of a block that satisfy a query: postings intersected and united."""

    def one(gram: str) -> Column:
        return F.coalesce(postings[gram], F.array().cast("array<bigint>"))

    def all_of(grams) -> Column:
        return reduce(F.array_intersect, [one(g) for g in sorted(grams)])

    return reduce(F.array_intersect, [reduce(F.array_union, [all_of(s) for s in clause]) for clause in query])


def _held_grams(low: Column, sets: set[frozenset[str]]) -> Column:
    """The trigrams of ``sets`` that a text holds, but for those of sets that it cannot hold whole.

    The trigram of most sets is looked for first; only where it is found are the others of its
    sets looked for. A set with a trigram that is missing is out of every intersection anyhow.
    """
    open_sets = {s for s in sets if s}
    if not open_sets:
        return F.array().cast("array<string>")
    grams = {g for s in open_sets for g in s}
    lead = min(grams, key=lambda g: (-sum(g in s for s in open_sets), g))
    with_it = {s - {lead} for s in open_sets if lead in s}
    found = F.when(F.contains(low, F.lit(lead)), F.concat(F.array(F.lit(lead)), _held_grams(low, with_it)))
    return F.concat(
        found.otherwise(F.array().cast("array<string>")), _held_grams(low, {s for s in open_sets if lead not in s})
    )


def candidates(texts: DataFrame, key: str, text: str, rules=RULES) -> DataFrame:
    """(key, rules): the numbers of the rules whose trigram query the text satisfies.

    ``texts`` has a 64-bit ``key`` of each text. Equal texts share a key and are posted once;
    should different texts share one, their trigrams unite, which adds candidates but loses none.
    A posting list spans one block of keys, so its length is bounded however common its trigram is.
    """
    queries = {n: q for n, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    sets = {s for q in queries.values() for clause in q for s in clause}
    blocks = parts_for(texts.count(), BLOCK_TEXTS)
    # A lambda binds the lowered text, so that it is made once and not for every trigram.
    marks = F.transform(F.array(F.lower(text)), lambda low: _held_grams(low, sets))
    held = texts.select(F.col(key).alias("key"), marks[0].alias("held"))
    postings = (
        # The plain explode would get a filter on the array pushed below it, which works it out twice.
        held.select("key", F.explode_outer("held").alias("gram"))
        .where("gram IS NOT NULL")
        .groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "gram")
        .agg(F.collect_set("key").alias("keys"))
    )
    blocked = postings.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("gram", "keys"))).alias("index"))
    found = [
        F.struct(F.lit(n).alias("rule"), _postings_of(q, F.col("index")).alias("keys")) for n, q in queries.items()
    ]
    return (
        blocked.select(F.explode(F.array(*found)).alias("f"))
        .select("f.rule", F.explode("f.keys").alias(key))
        .groupBy(key)
        .agg(F.collect_set("rule").alias("rules"))
    )


def find_secrets(docs: DataFrame, text: str = "text", out: str = "spans", rules=RULES) -> DataFrame:
    """``docs`` and a column ``out``: spans of secrets, array of (start, kind, end) by start.

    ``start`` and ``end`` count code points, the end is exclusive, ``kind`` is a rule's number.
    Rules with mandatory trigrams are looked up in the index and verified in the candidates
    only; the others scan every text.

    Rows come back as they are, one for one, with null texts taken as empty: these, empty texts
    and texts without secrets get an empty array. Copies get equal spans. Columns that clash with
    inner names are safe; one that is named ``out`` is an error. An empty table gives none.
    A text is searched whole, in time that grows with its length and its matches, not with their square.
    """
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {out} already")
    key, hits = spare(docs, "__key", "__rules")
    keyed = docs.withColumn(key, F.xxhash64(text_of(text)))
    whole = keyed.select(key, text_of(text).alias("body"))
    # Few texts are candidates: while they are few by count, they go to the texts and not the texts to them.
    known, counted = materialize_counted(candidates(whole, key, "body", rules).withColumnRenamed("rules", hits), "candidates")
    joined = keyed.join(broadcast_if_small(known, counted["rows"]), key, "left")
    body = text_of(text)
    none = F.array().cast(SPANS)
    found = [
        F.when(F.array_contains(hits, n), _found(body, r)).otherwise(none) if trigram_query(r.pattern) else _found(body, r)
        for n, r in enumerate(rules)
    ]
    spans = F.array_sort(F.concat(*found))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], spans.alias(out))


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", rules=RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; overlapping spans are one.

    Rows without secrets stay as they are, null texts included; no row is added or dropped. A text with
    secrets is held at four bytes a character meanwhile, so it may have half a billion of them; its time
    grows with its length and the number of its secrets.
    """
    spans = spare(docs, "__spans")[0]
    found = find_secrets(docs, text, spans, rules)
    body = F.col(f"`{text}`")
    # Characters of one width can be cut out anywhere without a walk from the start of the text.
    wide = F.encode(body, "UTF-32")

    def between(wide: Column, start: Column, end: Column) -> Column:
        # A decoder takes the first byte-order mark away, so each piece gets one, and its own stay.
        piece = F.substring(wide, start * 4 + 1, (end - start) * 4)
        return F.decode(F.concat(F.lit(b"\x00\x00\xfe\xff"), piece), "UTF-32")

    def joined(wide: Column, reach: Column) -> Column:
        """Text before each span that begins beyond all earlier ones, a mark for each, and the rest."""
        cuts = F.zip_with(
            F.col(spans), F.concat(F.array(F.lit(0)), F.slice(reach, 1, F.size(reach) - 1)),
            lambda s, at: F.struct(at.alias("at"), s["start"].alias("start")),
        )
        pieces = F.transform(
            F.filter(cuts, lambda c: c["start"] >= c["at"]),
            lambda c: F.concat(between(wide, c["at"], c["start"]), F.lit(mark)),
        )
        rest = between(wide, F.element_at(reach, -1), F.floor(F.octet_length(wide) / 4).cast("int"))
        return F.concat(F.array_join(pieces, ""), rest)

    ends = _running(F.transform(F.col(spans), lambda s: s["end"]), F.greatest)
    merged = _bound(wide, lambda w: _bound(ends, lambda reach: joined(w, reach)))
    clean = F.when(F.size(spans) > 0, merged).otherwise(body)
    return found.select(*[clean.alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns])


def span_list(spans: Column, rules=RULES) -> Column:
    """Spans as text, kind:start:end joined by commas, in their order."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
    )
