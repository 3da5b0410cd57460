"""License scan with ordered signature rules, in built-in SQL functions only.

A text is lower-cased (A-Z), reduced to its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` joined by single
spaces, and matched against the ordered rules of ``license_rules``. A rule has a label, a priority, a score, a
keyword that any match must hold, and a regular expression over the words. Prefilter: a text without one
of the ``GATES`` words can hold no match of any rule and is only counted; in the others a rule is tried where
its keyword is there. All places of all matches are found; a place inside another one of higher priority, or
of equal priority and greater length, is suppressed, and so is the later of two equal ones. What is left
gives the labels, and the greatest score.

Words are matched in blocks of ``BLOCK``, each with ``REACH`` words of its neighbours on both sides. No match
is longer than ``REACH`` words, so a place and all that can suppress it are seen whole in the block where it
begins, and the work grows with the words of a text, not with their square.

Base phrases (``BASE``) are counted apart and never suppressed: n_base places, with the number of the first
and last word where one begins.

Null text: no words, no labels (empty strings), score 0, null first_word and last_word. Rows that repeat get
equal results; no row leaves its task, so neither long nor hot texts gather anywhere. An empty table gives no
rows. Columns other than key and text aren't read, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import GATES, RULES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Words matched together, and words that a match has at most.
BLOCK, REACH = 512, 48


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


_PLACES = "array<struct<b:int,e:int,p:int,s:double,label:string>>"


def _let(value: Column, use) -> Column:
    """use(value) with the value computed once: an expression inside a lambda would be computed wherever it stands."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _places(hit: Column) -> Column:
    """All places of a rule that matched in a block (p, s, label, m: matches, t: what lies between): (begin, end) in words, priority, score, label."""
    step = F.aggregate(
        F.arrays_zip(hit["m"].alias("m"), F.slice(hit["t"], F.lit(1), F.size(hit["m"])).alias("t")),
        F.struct(F.lit(-1).alias("at"), F.from_json(F.lit("[]"), _PLACES).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + _spaces(x["t"]) + _spaces(x["m"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + _spaces(x["t"])).alias("b"), (acc["at"] + _spaces(x["t"]) + _spaces(x["m"]) + 1).alias("e"), hit["p"].alias("p"), hit["s"].alias("s"), hit["label"].alias("label")))).alias("out"),
        ),
    )
    return step["out"]


def tried_rules(word_blocks: str) -> Column:
    """(at, hits) of each block (at, w) of the named column: the rules whose keyword is there and that match; each rule is a literal pattern."""
    tried = []
    for label, p, s, key, pattern in RULES:
        regex = _quoted(f"(?<= ){pattern}(?= )")
        tried.append(f"if(contains(x.w, {_quoted(key)}), struct({p} AS p, {s}D AS s, {_quoted(label)} AS label, regexp_extract_all(x.w, {regex}, 0) AS m, split(x.w, {regex}) AS t), null)")
    return F.expr(f"transform({word_blocks}, x -> struct(x.at AS at, filter(array({', '.join(tried)}), h -> size(h.m) > 0) AS hits))")


def unsuppressed(found: Column) -> Column:
    """Places that no other covers: higher priority first, then greater length, then order of the rules."""

    def covers(x: Column, y: Column) -> Column:
        e, d = x["d"], y["d"]
        inside = (e["b"] <= d["b"]) & (e["e"] >= d["e"])
        longer = (e["e"] - e["b"]) > (d["e"] - d["b"])
        same = (e["b"] == d["b"]) & (e["e"] == d["e"])
        return inside & ((e["p"] > d["p"]) | ((e["p"] == d["p"]) & (longer | (same & (x["i"] < y["i"])))))

    numbered = F.transform(found, lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return _let(numbered, lambda all_: F.transform(F.filter(all_, lambda y: ~F.exists(all_, lambda x: covers(x, y))), lambda y: y["d"]))


def _before(at: Column) -> Column:
    return F.least(at, F.lit(REACH))


def blocks(words: Column) -> Column:
    """(at, w): padded words of each block, with those of its neighbours; at: its first own word."""

    def cut(array: Column) -> Column:
        heads = F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), F.lit(BLOCK))
        part = lambda at: F.slice(array, at - _before(at) + 1, _before(at) + BLOCK + REACH)
        return F.transform(heads, lambda at: F.struct(at.alias("at"), F.concat(F.lit(" "), F.array_join(part(at), " "), F.lit(" ")).alias("w")))

    return _let(words, cut)


def detections(hits: Column) -> Column:
    """Places of all rules in a text, from the hits of its blocks, suppressed ones left out."""

    def in_block(x: Column) -> Column:
        at, head = x["at"], _before(x["at"])
        own = F.filter(unsuppressed(F.flatten(F.transform(x["hits"], _places))), lambda d: (d["b"] >= head) & (d["b"] < head + BLOCK))
        return F.transform(own, lambda d: F.struct((d["b"] + at - head).alias("b"), (d["e"] + at - head).alias("e"), d["p"].alias("p"), d["s"].alias("s"), d["label"].alias("label")))

    return F.flatten(F.transform(hits, in_block))


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of every row."""
    low = F.coalesce(_lower(F.col(text).cast("string")), F.lit(""))
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains("low", F.lit(word))
    rows = docs.select(F.col(key).alias("k"), low.alias("low"))
    rows = rows.select("k", F.regexp_count("low", F.lit(WORD)).cast("long").alias("n_words"), F.when(gate, F.concat(F.lit(" "), F.trim(F.regexp_replace("low", GAP, " ")), F.lit(" "))).alias("words"))
    counts, firsts, lasts, held = [], [], [], []
    for phrase, label in BASE:
        padded = f" {phrase} "
        counts.append(F.regexp_count("words", F.lit(f"(?<= ){phrase}(?= )")))
        at = F.locate(padded, F.col("words"))
        firsts.append(F.when(at > 0, _spaces(F.expr(f"substring(words, 1, locate('{padded}', words))")) - 1))
        back = F.expr(f"length(words) - locate('{padded[::-1]}', reverse(words)) - {len(padded) - 2}")
        lasts.append(F.when(at > 0, _spaces(F.substring(F.col("words"), F.lit(1), back)) - 1))
        held.append(F.when(at > 0, F.lit(label)))
    found = rows.select(
        "k",
        "n_words",
        F.coalesce(sum(counts[1:], counts[0]), F.lit(0)).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*held)).alias("base"),
        F.when(F.col("words").isNotNull(), blocks(F.split(F.trim("words"), " "))).alias("blocks"),
    )
    found = found.withColumn("hits", tried_rules("blocks")).drop("blocks").withColumn("kept", detections(F.col("hits"))).drop("hits")
    names = F.coalesce(F.transform("kept", lambda d: d["label"]), F.expr("cast(array() as array<string>)"))
    return found.select(
        F.col("k").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.sort_array("base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", names)), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda d: d["s"])), F.lit(0.0)).alias("score"),
        F.col("kept").alias("detections"),
    )
