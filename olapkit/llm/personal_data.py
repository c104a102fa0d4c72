"""Personal data: patterns, and terms that reveal a protected value by their co-occurrence with it.

The patterns (mail and network addresses, card and telephone numbers) give the
base spans. Protected entities are every value found, what several values share (mail domain and name,
network, card issuer, dialling code), and that a text holds a value of a kind at all. For each term of a text with
an entity, wherever it stands outside the spans, the corpus tells how much of the
entity's information the term gives away:

    disclosure(t, e) = log2(n(t, e) * n / (n(t) * n(e))) / log2(n / n(e))

with n different texts, n(e) of them with the entity, n(t) with the term, and n(t, e)
with both; copies of a text prove nothing. It is 1 if the term occurs nowhere else.
A term is sanitised in all texts of an entity, wherever it occurs there, if it discloses
``GENERALISE`` of it or more and rarity rules out chance: the bits of all meetings,
n(t, e) * log2(n(t, e) * n / (n(t) * n(e))), must exceed log2 of the number of pairs that were
tried, or of n if that is more, which a single text never does. From ``REMOVE`` on
a term is removed, below that it is generalised to the kind of word it is.

Everything runs as DataFrame expressions. Positions come from the lengths of
matches and of what lies between them.

Defined results: a null text counts as empty and stays null when sanitised; an
empty text has no spans; spans depend on the text alone, so rows may repeat;
extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from olapkit.llm.common import let, text_of
from olapkit.workspace import materialize, materialize_counted

GENERALISE, REMOVE = 0.9, 0.99
#: Up to so many candidate terms are sent to all tasks; beyond, each text is shuffled once instead.
BROADCAST_TERMS = 1 << 18
TERM = r"[\p{L}\p{N}]++"

# The kinds in their order, and their patterns. The look-behinds and
# possessive repeats find what the plain patterns find, in time linear in the text.
KINDS = ["email", "ip", "card", "phone", "term"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of fewer than twelve digits can't be cards; runs are maximal, so they needn't be listed.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    def total(digits: Column) -> Column:
        def step(so_far: Column, i: Column) -> Column:
            digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
            double = digit * 2
            return so_far + F.when(i % 2 == 1, digit).otherwise(double - F.when(double > 9, 9).otherwise(0))

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)

    return let(_digits(match), total) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if kind == "card":
        # The sum is only taken over numbers of the right length.
        return F.when(F.length(_digits(match)).between(12, 19), _luhn(match)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """All matches, or those to keep, as array<struct<start, end, match>>, in code points."""
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def walk(pieces: Column) -> Column:
        matches, gaps = pieces["matches"], pieces["gaps"]

        def step(state: Column, i: Column) -> Column:
            match = F.element_at(matches, i)
            start = state["at"] + F.length(F.element_at(gaps, i))
            end = start + F.length(match)
            found = F.array(F.struct(start.alias("start"), end.alias("end"), match.alias("match")))
            more = F.concat(state["found"], found)
            return F.struct(end.alias("at"), (F.when(keep(match), more).otherwise(state["found"]) if keep else more).alias("found"))

        start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
        walked = F.aggregate(F.sequence(F.lit(1), F.size(matches)), start, step, lambda state: state["found"])
        return F.when(F.size(matches) > 0, walked).otherwise(empty)

    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    return let(F.struct(matches.alias("matches"), F.split(text, pattern, -1).alias("gaps")), walk)


_SPANS = "array<struct<start:int,order:int,end:int,kind:string,match:string>>"


def _spans_of(kind: str, text: Column) -> Column:
    def span(found: Column) -> Column:
        order, name = F.lit(KINDS.index(kind)).alias("order"), F.lit(kind).alias("kind")
        return F.struct(found["start"].alias("start"), order, found["end"].alias("end"), name, found["match"].alias("match"))

    found = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["match"]))
    sign = {"email": "@", "phone": "+", "ip": "."}.get(kind)
    spans = F.transform(found, span).cast(_SPANS)
    return F.when(F.contains(text, F.lit(sign)), spans).otherwise(F.array().cast(_SPANS)) if sign else spans


def base_spans(text: Column) -> Column:
    """array<struct<start, order, end, kind, match>> of the four patterns, sorted."""
    return F.array_sort(F.concat(*[_spans_of(kind, text) for kind in KINDS[:4]]))


def _entities(span: Column) -> Column:
    """What a span must not be told by: its value, the classes of values it belongs to, and its kind.

    Numbers are taken by their digits, addresses in small letters. A value is mostly in one text only; its mail
    domain, name, network, issuer or dialling code, and its kind, are what several texts share.
    """
    small, digits = F.lower(span["match"]), _digits(span["match"])

    def of(kind: str, name: str, value: Column) -> Column:
        return F.when(span["kind"] == kind, F.concat(F.lit(f"{name}:"), value))

    told = F.array(
        F.concat(F.lit("kind:"), span["kind"]),
        of("email", "email", small),
        of("email", "mail domain", F.substring_index(small, "@", -1)),
        of("email", "mail name", F.substring_index(small, "@", 1)),
        of("ip", "ip", small),
        of("ip", "network", F.substring_index(small, ".", 3)),
        of("card", "card", digits),
        of("card", "issuer", F.substring(digits, 1, 6)),
        of("phone", "phone", digits),
        of("phone", "dialling code", F.substring(digits, 1, 4)),
    )
    return F.filter(told, lambda e: e.isNotNull())


def _words(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda w: w != "")


def _terms(text: Column, spans: Column) -> Column:
    """The different terms of a text outside its spans, in small letters."""
    blank = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(" ").alias("label")))
    return F.array_intersect(_words(let(blank, lambda b: sanitised(text, b))), _words(text))


def find_base(documents: DataFrame) -> DataFrame:
    """(doc_id, key, spans) of every document, stored, with text, entities and terms if it has spans; ``key`` stands for the text."""
    text = text_of()
    rows = documents.select("doc_id", text.alias("text"), base_spans(text).alias("spans"))
    some = F.size("spans") > 0
    return materialize(
        rows.select(
            "doc_id",
            F.unhex(F.md5("text")).alias("key"),
            "spans",
            F.when(some, F.col("text")).alias("text"),
            F.when(some, F.array_distinct(F.flatten(F.transform("spans", _entities)))).alias("entities"),
            F.when(some, _terms(F.col("text"), F.col("spans"))).alias("terms"),
        ),
        "found",
    )


def few_terms(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): how many different texts hold each term. The terms go to the words; what is left is shuffled."""
    # The key goes through the explode, or else it would be hashed again for every word.
    pairs = let(
        F.unhex(F.md5(text_of())),
        lambda k: F.transform(_words(text_of()), lambda w: F.struct(k.alias("key"), w.alias("term"))),
    )
    words = documents.select(F.explode(pairs).alias("p")).select("p.key", "p.term")
    return words.join(F.broadcast(terms), "term", "left_semi").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


def many_terms(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """The same for terms of any number: each text is taken once, and its words are counted in the tasks first."""
    once = documents.select(text_of().alias("text")).groupBy(F.md5("text").alias("key")).agg(F.any_value("text").alias("text"))
    words = once.select(F.explode(_words(F.col("text"))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(terms, "term", "left_semi")


def disclosing_terms(documents: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms that give away GENERALISE of an entity or more."""
    n = found.select("key").distinct().count()
    tried = texts.agg(F.sum(F.size("entities").cast("long") * F.size("terms"))).first()[0] or 0
    # One text proves nothing, so what is in one text only needn't be joined.
    holders = texts.select("key", F.explode("entities").alias("entity"))
    by_entity = holders.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).where((F.col("n_e") > 1) & (F.col("n_e") < n))
    inside = texts.select("key", F.explode("terms").alias("term"))
    by_term = inside.groupBy("term").agg(F.count(F.lit(1)).alias("n_c")).where("n_c > 1")
    held = materialize(holders.join(by_entity, "entity"), "held")
    known = materialize(inside.join(by_term, "term"), "terms")

    def bits(n_t: str) -> Column:
        return F.log2(F.col("n_te") * n / (F.col(n_t) * F.col("n_e")))

    def told(n_t: str) -> Column:
        enough = F.col("n_te") * bits(n_t) > F.log2(F.lit(float(max(n, tried, 1))))
        return enough & (bits(n_t) / F.log2(n / F.col("n_e")) >= GENERALISE)

    # A term is in at least as many texts as in those with spans: what falls short with
    # that count falls short with all, and needn't be counted over the corpus.
    met = held.join(known, "key").where(F.col("n_c") <= F.col("n_e") * F.pow(n / F.col("n_e"), F.lit(1 - GENERALISE)) + 1)
    rates = met.groupBy("entity", "term", "n_e", "n_c").agg(F.count(F.lit(1)).alias("n_te"))
    candidates = materialize(rates.where(told("n_c")), "candidates")
    terms, number = materialize_counted(candidates.select("term").distinct(), "candidate-terms")
    everywhere = (few_terms if number <= BROADCAST_TERMS else many_terms)(documents, terms)
    rated = candidates.join(everywhere, "term").where(told("n_t"))
    return rated.select("entity", "term", (bits("n_t") / F.log2(n / F.col("n_e"))).alias("disclosure"))


def find_personal_data(documents: DataFrame) -> DataFrame:
    """(doc_id, key, base, spans) of every document: base spans, and all spans with disclosing terms.

    A span is a struct of start, order, end, kind and label, what stands for it in a sanitised text.
    """
    found = find_base(documents)
    # Equal texts have equal spans: one row for each text.
    firsts = [F.any_value(c).alias(c) for c in ("spans", "text", "entities", "terms")]
    texts = materialize(found.where(F.size("spans") > 0).groupBy("key").agg(*firsts), "texts")
    bad = materialize(disclosing_terms(documents, found, texts), "disclosing")
    # From the terms that stand in a text to the entities they disclose, and which of these are the text's own:
    # a kind has many terms and many texts, and few of them meet.
    holders = texts.select("key", F.explode("entities").alias("entity"))
    by_text = (
        texts.select("key", F.explode("terms").alias("term"))
        .join(bad, "term")
        .join(holders, ["key", "entity"], "left_semi")
        .groupBy("key", "term")
        .agg(F.max("disclosure").alias("disclosure"))
    )
    told = by_text.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("told"))
    places = located(F.col("text"), TERM, lambda m: F.map_contains_key("told", F.lower(m)))
    occurrences = (
        texts.join(materialize(told, "told"), "key")
        .select("key", "spans", "told", F.explode(places).alias("t"))
        .where(~F.exists("spans", lambda s: (s["start"] < F.col("t.end")) & (F.col("t.start") < s["end"])))
        .select("key", "t.start", "t.end", "t.match", F.col("told")[F.lower("t.match")].alias("disclosure"))
    )
    label = (
        F.when(F.col("disclosure") >= REMOVE, "")
        .when(F.col("match").rlike("[0-9]"), "[NUMBER]")
        .when(F.col("match").rlike(r"^\p{Lu}"), "[NAME]")
        .otherwise("[WORD]")
    )
    span = F.struct("start", F.lit(4).alias("order"), "end", F.lit("term").alias("kind"), label.alias("label"))
    added = occurrences.groupBy("key").agg(F.collect_list(span).alias("added"))
    base = F.transform(
        "spans",
        lambda s: F.struct(s["start"], s["order"], s["end"], s["kind"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("label")),
    )
    return (
        found.select("doc_id", "key", base.alias("base"))
        .join(materialize(added, "added"), "key", "left")
        .select(
            "doc_id",
            "key",
            "base",
            F.array_sort(F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))).alias("spans"),
        )
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with its sorted spans replaced; what overlaps an earlier span goes with it."""

    def step(state: Column, s: Column) -> Column:
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), s["label"])
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans, zero, step, lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))
    )


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with sanitised texts; texts without spans stay as they are."""
    found = find_personal_data(documents).where(F.size("spans") > 0).select("key", "spans")
    # Equal texts have equal spans: one row for each text.
    spans = materialize(found.groupBy("key").agg(F.any_value("spans").alias("spans")), "spans")
    names = [F.col(f"`{c}`") for c in documents.columns]
    rows = documents.select(F.struct(*names).alias("row"), F.unhex(F.md5(text_of())).alias("key")).join(spans, "key", "left")
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(sanitised(F.col("row.text"), F.col("spans")))
    return rows.select(*[(text if c == "text" else F.col("row")[c]).alias(c) for c in documents.columns])
