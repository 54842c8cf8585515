"""Line dedup: an exact set-similarity join of lines, which removes later matches.

A line is the set of its words; it is removed if an earlier line (by doc_id, then line) has a Jaccard
likeness of at least 4/5 with it. Built-in expressions only.

1. Lines with one and the same bag of words meet under a digest of it: 128 bits of SHA-256 over the
   words themselves. The first line of each bag stands for all of them; it is found by a minimum that tasks
   take before anything is shuffled, so a line that is everywhere is one row a task. Sets are numbered in
   the order of their first lines. A document is told by its id and as many bits of its text.
2. Words are ordered by rarity. How often each of 65,536 word classes occurs in all lines is counted,
   and a word's place in the order is the frequency of its class, then its hash: a total order of all
   words, in which frequent words come last.
3. Sets can only match if they share a word of their prefixes (the n - need + 1 rarest words). The key of an
   entry is that word. Where more than `HOT` prefixes hold a word, keys are the word with each further one of
   a prefix longer by one, as matching sets share two words of those; such keys are dealt into groups of
   about `HOT` entries.
4. Within a key or group every set meets the earliest one and, where that cannot match, the `NEAR` ones before
   it; the earliest sets of the groups of a key meet the earliest of them all. Lengths, positions and 128
   parities of the words rule most meetings out, the rest is verified on the words. So a family of many
   near-copies costs one meeting a set and key.
5. Sets that have not met all earlier ones of their keys, and have no match yet, meet them now, under the
   same filters and the same verification.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyfare.llm.common import held, whole_text
from skyfare.operators.lookup import lookup_join
from skyfare.scratch import Held, hold

BROADCAST_BYTES = 32 << 20  # of measured tables of line numbers and words
NUM, DEN = 4, 5  # the likeness, as a fraction
LEAST_WORDS = 4  # sets of fewer words are alike only if they are equal
HOT = 4096  # prefixes that may hold a word before its entries are divided
NEAR = 32  # earlier sets of a key that a set meets at once
_BLANK = " \t\x0b\f\r"
_CLASSES = 1 << 16
_PLACE, _STEP = 33, 2.5  # a class that occurs c times has place 33 + 2.5 log2 c


def _digest(text: str) -> str:
    return f"substring(unhex(sha2(CAST({text} AS binary), 256)), 1, 16)"


def _doc_of(docs: DataFrame) -> Column:
    """What tells documents apart, also texts that share a doc_id: the id, then a digest of the text."""
    return F.struct(docs["doc_id"].alias("id"), F.call_function("substring", F.unhex(F.sha2(whole_text(docs).cast("binary"), 256)), F.lit(1), F.lit(16)).alias("digest"))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, line, text): a row per line of `docs`; `doc` is (doc_id, digest of the text)."""
    named = docs.select(_doc_of(docs).alias("doc"), whole_text(docs).alias("text"))  # one digest a document, not one a line
    return named.select("doc", F.posexplode(F.split("text", "\n")).alias("line", "text"))


def _split(text: Column) -> Column:
    """The lower-cased words of a text, and empty strings where blanks meet."""
    other = F.lit(False)
    for blank in _BLANK[1:]:
        other = other | F.contains(text, F.lit(blank))
    spaced = F.when(other, F.translate(text, _BLANK, " " * len(_BLANK))).otherwise(text)
    return F.split(F.lower(spaced), " ")


def _with_words(lines: DataFrame) -> DataFrame:
    """Lines that have words, with the lower-cased words; they may repeat, and empty strings stand among them."""
    worded = lines.filter(F.btrim("text", F.lit(_BLANK)) != "")
    return worded.withColumn("words", _split(F.col("text"))).drop("text")


def _class_of(h: str) -> str:
    return f"shiftrightunsigned({h}, 48)"


def word_classes(lines: DataFrame) -> list[int]:
    """For each class of words a number that grows with how often the class occurs in all lines."""
    words = lines.select(F.explode(_split(F.col("text"))).alias("w"))
    counts = (
        words.select(F.expr(_class_of("xxhash64(w)")).alias("c"))
        .groupBy("c")
        .agg(F.expr(f"int(least(126.0, {_PLACE} + {_STEP} * log2(count(1))))").alias("place"))
        .collect()
    )  # at most _CLASSES rows
    places = [_PLACE] * _CLASSES
    for r in counts:
        places[r.c] = r.place
    return places


def _parity(which: int) -> str:
    """64 bits, each telling whether an odd number of the words fall on it; sets differ in at least as many
    words as bits, and long lines fill a map no more than short ones."""
    return f"aggregate(tokens, 0L, (m, t) -> m ^ IF((t & 64) = {which}, shiftleft(1L, int(t & 63)), 0L))"


def _with_tokens(worded: DataFrame, places: list[int]) -> DataFrame:
    """`tokens`: the different words as numbers, rarest first; `n` of them; `map` and `map2`: their parities."""
    table = f"from_json('{places}', 'array<bigint>')"  # folded into a literal
    token = f"shiftleft(get({table}, int({_class_of('h')})), 56) | shiftrightunsigned(h, 8)"
    hashes = F.expr("array_distinct(transform(words, w -> xxhash64(w)))")  # numbers are told apart faster than words
    hashed = worded.withColumn("hashes", F.array_remove(hashes, F.xxhash64(F.lit(""))))
    return (
        hashed.withColumn("tokens", F.sort_array(F.expr(f"transform(hashes, h -> {token})")))
        .withColumn("n", F.size("tokens"))
        .withColumn("map", F.expr(_parity(0)))
        .withColumn("map2", F.expr(_parity(64)))
    )


def _ceil_div(a: str, b: int) -> str:
    return f"(({a}) + {b - 1}) DIV {b}"


def _may_match(a: str, b: str) -> str:
    """Whether set `b` is earlier and can be like enough to `a`, with which it shares a key: by length,
    position and parities.

    At the first word they share, both have at most what is left of the shorter rest in common; a
    true match passes at that word.
    """
    need = _ceil_div(f"{NUM}L * ({a}.n + {b}.n)", NUM + DEN)
    left = f"least({a}.n - {a}.at, {b}.n - {b}.at)"
    return (
        f"{b}.uid < {a}.uid AND least({a}.n, {b}.n) * {DEN} >= greatest({a}.n, {b}.n) * {NUM}"
        f" AND {left} >= {need}"
        f" AND bit_count({a}.map ^ {b}.map) + bit_count({a}.map2 ^ {b}.map2) <= {a}.n + {b}.n - 2 * ({need})"
    )


def _sets(tokened: DataFrame) -> DataFrame:
    """(digest, first): the first line of each bag of words (doc, line), with what the filters need; `tokens` is
    its prefix and one word more. The digest is of the words, in order, with a space between them. Repeats count,
    which saves telling words apart; bags of one set share their prefix. Sets without a prefix have no repeats."""
    need = _ceil_div(f"{NUM} * n", DEN)
    prefix = f"slice(tokens, 1, IF(n >= {LEAST_WORDS}, int(n - {need} + 2), 0))"
    bag = f"IF(n < {LEAST_WORDS}, array_distinct(words), words)"
    digest = _digest(f"ltrim(array_join(sort_array({bag}), ' '))")
    rows = tokened.select(F.expr(digest).alias("digest"), F.struct("doc", "line", "n", "map", "map2", F.expr(prefix).alias("tokens")).alias("first"))
    return rows.groupBy("digest").agg(F.min("first").alias("first"))


def _numbered(sets: DataFrame) -> DataFrame:
    """The first lines, with `uid`, a number that grows in their order."""
    order = ["doc.id", "doc.digest", "line"]
    placed = sets.select("first.*").repartitionByRange(*order).sortWithinPartitions(*order)
    return held(placed.withColumn("uid", F.monotonically_increasing_id()), "line-sets")


def _prefix_words(sets: DataFrame) -> DataFrame:
    """(uid, n, map, map2, tokens, at, token): a row per prefix word."""
    words = F.expr("slice(tokens, 1, greatest(size(tokens) - 1, 0))")
    return sets.select("uid", "n", "map", "map2", "tokens", F.posexplode(words).alias("at", "token"))


def _hot_words(sets: DataFrame) -> Held:
    """(token, n_sets) of words that more than `HOT` prefixes hold; no word is more frequent than its class."""
    least = int(_PLACE + _STEP * log2(HOT))
    frequent = _prefix_words(sets).filter(F.shiftrightunsigned("token", 56) >= least)
    return hold(frequent.groupBy("token").agg(F.count(F.lit(1)).alias("n_sets")).filter(F.col("n_sets") > HOT), "hot-words")


def _entries(sets: DataFrame, hot: Held) -> DataFrame:
    """(key, part, hot, e): a row per key of each set; `part` deals a hot key into groups."""
    marked = lookup_join(_prefix_words(sets), hot, {"token": "token"}, max_bytes=BROADCAST_BYTES, salt_by=["uid"])
    pairs = "transform(slice(tokens, at + 2, size(tokens)), t -> xxhash64(token, t))"
    keys = F.explode(F.expr(f"IF(n_sets IS NULL, array(token), {pairs})"))
    part = f"IF(n_sets IS NULL, 0, int(pmod(xxhash64(uid), n_sets DIV {HOT} + 1)))"
    return marked.select(
        keys.alias("key"), F.expr(part).alias("part"), F.col("n_sets").isNotNull().alias("hot"),
        F.struct("uid", "n", "at", "map", "map2").alias("e"),
    )


def _met(entries: DataFrame) -> DataFrame:
    """(uid, earlier, partial, top, key, e): earlier sets that each set may match, key by key.

    `partial` marks sets that have more earlier ones under the key than they have met, `top` the earliest
    one of each group of a hot key; either has a row of its own, `earlier` may be null there.
    """
    group = Window.partitionBy("key", "part").orderBy("e.uid")
    placed = (
        entries.withColumn("nth", F.row_number().over(group))
        .withColumn("lead", F.first("e").over(group.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("near", F.collect_list("e").over(group.rowsBetween(-NEAR, Window.currentRow)))
        .withColumn("leads", F.expr(_may_match("e", "lead")))
    )
    each = placed.withColumn("b", F.explode("near")).withColumn("own", F.expr("b.uid = e.uid"))
    more = F.expr(f"own AND (hot OR nth > {NEAR} + 1 OR (leads AND nth > 2))")
    return each.filter(F.expr(f"IF(own, leads, NOT leads AND {_may_match('e', 'b')})") | more).select(
        "e.uid", F.expr("IF(own, IF(leads, lead.uid, NULL), b.uid)").alias("earlier"),
        more.alias("partial"), F.expr("own AND hot AND nth = 1").alias("top"), "key", "e",
    )


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(uid) of later sets of `pairs` (later, earlier: uid) whose words are alike enough."""
    both = hold(pairs.select(F.explode(F.array("later", "earlier")).alias("uid")).distinct(), "candidates")
    named = lookup_join(sets.select("uid", "doc", "line"), both, {"uid": "uid"}, how="left_semi", max_bytes=BROADCAST_BYTES)
    wanted = hold(named.groupBy("doc").agg(F.collect_list(F.struct("line", "uid")).alias("lines")), "wanted-lines")
    worded = _with_words(lines_of_wanted(docs, wanted))
    words = held(worded.select("uid", F.array_remove(F.array_distinct("words"), "").alias("words")), "line-words")
    joined = (
        pairs.join(words.select(F.col("uid").alias("later"), F.col("words").alias("a")), "later")
        .join(words.select(F.col("uid").alias("earlier"), F.col("words").alias("b")), "earlier")
        .withColumn("shared", F.size(F.array_intersect("a", "b")))
    )
    alike = F.col("shared") * DEN >= (F.size("a") + F.size("b") - F.col("shared")) * NUM
    return joined.filter(alike).select(F.col("later").alias("uid")).distinct()


def lines_of_wanted(docs: DataFrame, wanted: Held) -> DataFrame:
    """(uid, text) of the lines that `wanted` (doc, lines: line, uid) names; rows that repeat give one."""
    text = whole_text(docs)
    rows = lookup_join(
        docs.select(_doc_of(docs).alias("doc"), text.alias("text")), wanted, {"doc": "doc"}, how="inner",
        max_bytes=BROADCAST_BYTES, salt_by=["text"],
    )
    each = rows.withColumn("split", F.split("text", "\n")).select(F.explode("lines").alias("x"), "split")
    lines = each.select("x.uid", F.element_at("split", F.col("x.line") + 1).alias("text"))
    return lines.groupBy("uid").agg(F.first("text").alias("text"))


def kept_lines(docs: DataFrame) -> DataFrame:
    """(doc, line): every line of `docs` (doc_id, text) that has words and no earlier line that matches it."""
    docs = docs.select(docs["doc_id"], whole_text(docs).alias("text"))
    lines = lines_of(docs)
    sets = _numbered(_sets(_with_tokens(_with_words(lines), word_classes(lines))))
    hot = _hot_words(sets)

    # every set against the earliest one and the nearest ones of each key
    met = held(_met(_entries(sets, hot)), "met")
    tops = met.filter("top").select("uid", "e", F.first("e").over(Window.partitionBy("key").orderBy("uid")).alias("lead"))
    pairs = met.filter("earlier IS NOT NULL").select(F.col("uid").alias("later"), "earlier").unionByName(
        tops.filter(_may_match("e", "lead")).select(F.col("uid").alias("later"), F.col("lead.uid").alias("earlier"))
    )
    found = hold(_verified(held(pairs.distinct(), "pairs"), sets, docs), "found")

    # what is left against every earlier set of its keys
    partial = met.filter("partial").select("uid", "key", F.col("e").alias("l"))
    later = held(_without(partial, found).select("key", "l"), "undecided")
    keys = hold(later.select("key").distinct(), "their-keys")
    earlier = lookup_join(
        _entries(sets, hot).select("key", "e"), keys, {"key": "key"}, how="left_semi", max_bytes=BROADCAST_BYTES, salt_by=["e"]
    )
    rest = later.join(earlier, "key").filter(_may_match("l", "e"))
    rest = held(rest.select(F.col("l.uid").alias("later"), F.col("e.uid").alias("earlier")).distinct(), "further-pairs")
    gone = found.df.unionByName(_verified(rest, sets, docs))
    return sets.join(gone, "uid", "left_anti").select("doc", "line")


def _without(rows: DataFrame, sets: Held) -> DataFrame:
    """Rows whose `uid` is not among `sets`; a set has no more rows than keys."""
    side = F.broadcast(sets.df) if sets.size <= BROADCAST_BYTES else sets.df
    return rows.join(side, "uid", "left_anti")


def _with_gone(docs: DataFrame) -> DataFrame:
    """`docs` with `_doc`, which names the document, `_text`, and `_gone`: the numbers of the lines to remove."""
    kept = held(kept_lines(docs).groupBy("doc").agg(F.collect_list("line").alias("_kept")), "kept-lines")
    text = whole_text(docs)
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.when(F.btrim(line, F.lit(_BLANK)) != "", i))
    worded = F.filter(numbered, lambda i: i.isNotNull())
    rows = docs.withColumns({"_doc": _doc_of(docs), "_text": text, "_worded": worded})
    joined = rows.join(kept.withColumnRenamed("doc", "_doc"), "_doc", "left")
    gone = F.array_except("_worded", F.coalesce("_kept", F.expr("CAST(array() AS array<int>)")))
    return joined.withColumn("_gone", gone).drop("_worded", "_kept")


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc, line): every line of `docs` (doc_id, text) with an earlier line that matches it."""
    gone = _with_gone(docs.select("doc_id", "text"))
    return gone.select(F.col("_doc").alias("doc"), F.explode("_gone").alias("line")).distinct()


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, removed) for every row of `docs`: which of its lines go, counted from 0.

    Lines end at \\n; null text counts as empty, which is one line without words. Lines without words
    stay. Rows that repeat both doc_id and text count as one document and fare alike; null ids come first.
    """
    n_lines = F.size(F.split("_text", "\n")).cast("bigint")
    return _with_gone(docs.select("doc_id", "text")).select("doc_id", n_lines.alias("n_lines"), F.col("_gone").alias("removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with the text of the lines that stay, all other columns as they are."""
    kept = F.array_join(F.filter(F.split("_text", "\n"), lambda _, i: ~F.array_contains("_gone", i)), "\n")
    return _with_gone(docs).withColumn("text", kept).select(*docs.columns)
