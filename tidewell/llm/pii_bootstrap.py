"""Personal data in texts: fixed kinds by pattern, more of them by bootstrapped contexts.

Everything here is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.storage import stored

KINDS = ("email", "ip", "card", "phone")

# The patterns of the four kinds. Groups are possessive where what follows cannot
# give a place back, and a match may begin only where one can begin, so that long runs of
# letters or digits take linear time; matches are those of the plain patterns.
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: What an identifier that no pattern knows may look like: digits in groups, or text around an at.
_NUMBER = r"(?<![0-9A-Za-z.@-])[(+]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z@])"
_ADDRESS = r"(?<![^\x20\x09-\x0D])[A-Za-z0-9._%+-]{1,64}(?:@|\(at\)|\[at\])[A-Za-z0-9.-]{1,255}"

#: Code points before and after a span in which its context is looked for.
AROUND = 48
#: Rounds of scoring, different identifiers a pattern needs, its least confidence, and the
#: least confidence of an identifier.
ROUNDS, SUPPORT, SURE, ACCEPT = 3, 5, 0.9, 0.9

_SPANS = "array<struct<kind:int,start:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, kind: Column | int) -> Column:
    """Matches with their code points: the text between matches says where each one is."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    begun = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(held: Column, x: Column) -> Column:
        start = held["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(
            F.lit(kind).alias("kind") if isinstance(kind, int) else kind.alias("kind"),
            start.alias("start"), end.alias("end"), x["value"].alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(held["spans"], F.array(span)).alias("spans"))

    gaps = F.slice(between, 1, F.greatest(F.size(found), F.lit(0)))
    pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.aggregate(pairs, begun, step)["spans"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the weighted sum of the digits, from the last one on, is divisible by ten."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _base_spans(text: Column) -> Column:
    """Spans of the four kinds, in the order of kinds, then of places."""
    none = F.array().cast(_SPANS)

    def card_is_valid(x: Column) -> Column:
        digits = _digits(x["value"])
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)

    email = F.when(F.contains(text, F.lit("@")), _matches(text, _EMAIL, 0)).otherwise(none)
    ip = F.when(
        text.rlike(_IP),
        F.filter(_matches(text, _IP, 1), lambda x: x["value"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    ).otherwise(none)
    card = F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), F.filter(_matches(text, _CARD, 2), card_is_valid))
    phone = F.when(
        F.contains(text, F.lit("+")),
        F.filter(_matches(text, _PHONE, 3), lambda x: F.length(_digits(x["value"])).between(8, 15)),
    ).otherwise(none)
    return F.concat(email, ip, F.coalesce(card, none), phone)


def _loose_kind(value: Column) -> Column:
    """The kind that an identifier of no known pattern would be of, by its shape."""
    digits = F.length(_digits(value))
    return (
        F.when(value.rlike(r"@|\(at\)|\[at\]"), 0)
        .when(value.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), 1)
        .when(digits.between(12, 19), 2)
        .when(digits.between(7, 11), 3)
    )


def _candidates(text: Column, base: Column) -> Column:
    """Identifier-shaped stretches that overlap no base span."""
    none = F.array().cast(_SPANS)
    number = F.when(text.rlike(r"[0-9](?:[\x20().-]{0,2}[0-9]){6}"), _matches(text, _NUMBER, -1)).otherwise(none)
    address = F.when(text.rlike(r"@|\(at\)|\[at\]"), _matches(text, _ADDRESS, -1)).otherwise(none)

    def apart(x: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    shaped = F.transform(
        F.filter(F.concat(number, address), apart),
        lambda x: F.struct(_loose_kind(x["value"]).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")),
    )
    return F.filter(shaped, lambda x: x["kind"].isNotNull())


def _context(text: Column, x: Column) -> Column:
    """Lexical patterns around a span: the two words before it, and one word on each side."""
    before = F.lower(F.substring(text, F.greatest(x["start"] - AROUND, F.lit(0)) + 1, F.least(x["start"], F.lit(AROUND))))
    after = F.lower(F.substring(text, x["end"] + 1, F.lit(AROUND)))
    left = F.regexp_extract(before, r"(\p{L}+)[^\p{L}0-9]*$", 1)
    left2 = F.regexp_extract(before, r"(\p{L}+[^\p{L}0-9]+\p{L}+)[^\p{L}0-9]*$", 1)
    right = F.regexp_extract(after, r"^[^\p{L}0-9]*(\p{L}+)", 1)
    patterns = F.array(
        F.when(left2 != "", F.concat(F.lit("l "), F.regexp_replace(left2, r"[^\p{L}]+", " "))),
        F.when((left != "") & (right != ""), F.concat_ws(" ", F.lit("s"), left, right)),
    )
    return F.filter(patterns, lambda p: p.isNotNull())


def _with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, seen): base spans, and every span with the patterns around it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = found.withColumn("text_key", F.xxhash64("text"))
    # The base spans are written out first, so that no expression over the text is made twice.
    found = found.withColumn("base", _base_spans(F.col("text")))

    def seen(known: bool):
        return lambda x: F.struct(
            F.lit(known).alias("known"), x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.xxhash64(x["value"]).alias("value"), _context(F.col("text"), x).alias("patterns"),
        )

    return found.select(
        "doc_id",
        "text_key",
        F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("base"),
        F.concat(
            F.transform("base", seen(True)),
            F.transform(_candidates(F.col("text"), F.col("base")), seen(False)),
        ).alias("seen"),
    )


def _discovered(seen: DataFrame) -> DataFrame:
    """(kind, value) of identifiers that patterns of high confidence stand around.

    The graph has an edge for each pattern and identifier that meet anywhere, however often, so
    copies of a text add nothing. Seeds, found by the fixed patterns, are certain. A pattern is as
    sure of a kind as the identifiers of that kind are certain among all it stands around, and
    needs SUPPORT seeds; an identifier is as certain as its patterns together make it.
    """
    edges = stored(
        seen.select("known", "kind", "value", F.explode("patterns").alias("pattern")).groupBy("pattern", "kind", "value")
        .agg(F.max("known").alias("known")),
        "edges",
    )
    certain = edges.withColumn("certain", F.col("known").cast("double"))
    for _ in range(ROUNDS):
        patterns = certain.groupBy("pattern", "kind").agg(
            F.sum("certain").alias("for_it"), F.sum(F.col("known").cast("int")).alias("seeds"), F.count("*").alias("here")
        )
        whole = patterns.groupBy("pattern").agg(F.sum("here").alias("all"))
        patterns = patterns.where(F.col("seeds") >= SUPPORT).join(whole, "pattern")
        patterns = patterns.withColumn("sure", F.col("for_it") / (F.col("all") + 0.25)).where(F.col("sure") >= SURE - 0.4)
        patterns = stored(patterns.select("pattern", "kind", "sure"), "patterns")
        scored = (
            edges.where("not known").join(patterns, ["pattern", "kind"]).groupBy("kind", "value")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least("sure", F.lit(0.999)))))).alias("score"))
        )
        scored = stored(scored, "scored")
        certain = edges.join(scored, ["kind", "value"], "left").select(
            "pattern", "kind", "value", "known",
            F.when(F.col("known"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("certain"),
        )
    sure = patterns.where(F.col("sure") >= SURE)
    return (
        edges.where("not known").join(sure.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
        .select("kind", "value").distinct()
        .join(scored.where(F.col("score") >= ACCEPT), ["kind", "value"], "left_semi")
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, spans) for each row: arrays of (kind, start, end).

    ``base`` holds the matches of the four fixed patterns that pass their checks, ``spans`` these
    and the identifiers that were discovered, in the order of kinds, then of places; kinds are
    numbered as in KINDS, places are code points, end exclusive. An identifier shaped like one but
    matched by no fixed pattern is discovered if it stands in contexts that almost only seeds of one
    kind stand in; it is then marked wherever it occurs.

    A null text counts as empty and has no spans. Rows that repeat id and text have equal spans.
    Null ids are kept. Other columns are ignored.
    """
    found = stored(_with_spans(docs), "spans")
    seen = found.select("doc_id", "text_key", F.explode("seen").alias("x")).select("doc_id", "text_key", "x.*")
    more = stored(_discovered(seen), "discovered")
    added = (
        seen.where("not known").join(more, ["kind", "value"])
        .groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    )
    added = added.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "added")
    joined = found.join(
        stored(added, "added"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left"
    )
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return joined.select("doc_id", "text_key", "base", spans.alias("spans"))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string")),
        ),
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by the name of its kind, as in ``<EMAIL>``.

    Where spans overlap, the one that starts first (then the longer) names the mask, which covers
    them all. A null text stays null; all rows and columns are kept.
    """
    found = find_spans(docs).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans")
    )
    found = stored(found, "masks").dropDuplicates(["__id", "__key"])
    named = docs.withColumn("__text_key", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    # Merged at any size, so that what is shuffled grows as the texts do.
    joined = named.join(
        found.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left"
    )
    text = F.col("text")
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(held: Column, x: Column) -> Column:
        kept = F.substring(text, held["at"] + 1, F.greatest(x["start"] - held["at"], F.lit(0)))
        parts = F.when(
            x["start"] >= held["at"],
            F.concat(held["parts"], F.array(kept, F.element_at(names, x["kind"] + 1))),
        ).otherwise(held["parts"])
        return F.struct(F.greatest(held["at"], x["end"]).alias("at"), parts.alias("parts"))

    by_place = F.transform(
        F.sort_array(F.transform("__spans", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("end"), x["kind"].alias("kind")))),
        lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), (-x["end"]).alias("end")),
    )
    done = F.aggregate(
        by_place, begun, step,
        lambda held: F.concat(F.concat_ws("", held["parts"]), F.substring(text, held["at"] + 1, F.length(text))),
    )
    return joined.withColumn("text", F.when(F.col("__spans").isNull(), text).otherwise(done)).drop(
        "__id", "__key", "__spans", "__text_key"
    )
