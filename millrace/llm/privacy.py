"""Information-theoretic sanitisation of personal data. DataFrame functions only.

Emails, IP addresses, card and phone numbers are found by pattern; each value is an entity to protect. The corpus then
says which other terms give an entity away: over passages (up to `passage` consecutive words of a document),

    IC(c) = -log2 p(c)      PMI(c; t) = log2 p(c, t) / (p(c) p(t))

and a term t (one or two words) discloses c where PMI(c; t) >= threshold * IC(c): seeing t then tells nearly as much as
seeing c. Only what recurs is evidence: entity and term must stand together in passages of different documents that do not
copy one another (neither the passages nor the documents share one of 16 minima over three-word shingles, so that far
edited copies are known too). Disclosing terms become spans wherever they stand in the corpus; they are
removed where PMI >= remove * IC, else generalised to a class of form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import materialize

#: The patterns of personal data; fixed values. Written so that no text makes them try a place twice: runs are taken
#: whole (possessively) and begin where no run is cut, except right after an earlier match (\G).
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Of all digit chains those of 16 to 19 digits.
_CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){15,18}+(?![ -]?[0-9])"
PATTERNS = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
_NUMBER = rf"(?=[0-9+])(?:{_IP}|{_CARD}|{_PHONE})"
_ANY = f"{_EMAIL}|{_NUMBER}"
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_IP_VALID = rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$"
#: Fences around what looks like personal data; a word; a fenced stretch or a word.
FENCE = "\x01"
_WORD = r"[\p{L}\p{N}]++"
_TOKEN = f"{FENCE}[^{FENCE}]*+{FENCE}|{_WORD}"
#: Between the words of a pair; stands in no word.
PAIR = "\x02"
#: Sums are run over so many numbers, then over the sums of these.
CHUNK = 256
#: Characters of a text cut out of at once.
BLOCK = 4096
SHINGLE, MINIMA = 3, 16
#: Terms looked for by broadcast; beyond it the join is Spark's to plan.
BROADCAST_TERMS = 4_000_000
#: Classes with more than one in so many mentions are joined by broadcast; there are fewer than 32 * HOT_PARTS.
HOT_PARTS = 1000
SPAN = "array<struct<kind: string, start: bigint, end: bigint>>"


def _let(value: Column, then) -> Column:
    """`then(value)` with the value worked out once: a lambda that names a column may get its expression for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def running_sums(numbers: Column) -> Column:
    """For each place of an array the sum up to and with it, in time linear in practice."""
    zero = F.array(F.lit(0).cast("bigint"))
    add = lambda done, x: F.array_append(done, F.element_at(done, -1) + x)

    def inner(a: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(a) - 1, F.lit(0)), F.lit(CHUNK)), lambda i: F.slice(a, i + 1, CHUNK))
        return F.transform(chunks, lambda c: F.aggregate(c, zero, add))

    def whole(sums: Column) -> Column:
        bases = F.aggregate(F.transform(sums, lambda a: F.element_at(a, -1)), zero, add)
        return F.flatten(F.zip_with(sums, bases, lambda a, base: F.transform(F.slice(F.coalesce(a, zero), 2, CHUNK), lambda x: x + base)))

    return _let(_let(numbers, inner), whole)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(_IP_VALID)
    if kind == "card":
        return F.length(_digits(match)).between(16, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _maybe(kind: str, text: Column) -> Column:
    """A quick test that is true wherever the kind's pattern matches."""
    if kind in ("email", "phone"):
        return text.contains({"email": "@", "phone": "+"}[kind])
    return text.rlike({"ip": r"[0-9]\.[0-9]++\.[0-9]", "card": "[0-9](?:[ -]?+[0-9]){15}"}[kind])


def _with_places(rows: DataFrame, text: str, pattern: str, name: str, size, maybe: Column) -> DataFrame:
    """Adds `name`: all matches of a pattern in `text` as (match, start); `size` says how long a match is."""
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), 0)
    gaps = F.transform(F.split(F.col(text), pattern, -1), lambda g: F.length(g).cast("bigint"))

    def placed(p: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(p["matches"], lambda m: size(m).cast("bigint")))
        starts = running_sums(F.zip_with(p["gaps"], before, lambda g, n: F.coalesce(g, F.lit(0)) + F.coalesce(n, F.lit(0))))
        return F.zip_with(p["matches"], F.slice(starts, 1, F.size(p["matches"])), lambda m, s: F.struct(m.alias("match"), s.alias("start")))

    found = _let(F.struct(matches.alias("matches"), gaps.alias("gaps")), placed)
    return rows.withColumn(name, F.when(maybe, found).otherwise(F.array().cast("array<struct<match: string, start: bigint>>")))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the arrays `email`, `ip`, `card` and `phone` of (kind, start, end) in code points, end exclusive, by start.
    Every pattern is matched from left to right without overlap; matches that are no valid address or number are left out."""
    rows = docs
    for kind, pattern in PATTERNS.items():
        rows = _with_places(rows, text, pattern, kind, F.length, _maybe(kind, F.col(text)))
        good = F.filter(kind, lambda x: _valid(kind, x["match"]))
        rows = rows.withColumn(kind, F.transform(good, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["match"])).alias("end"))).cast(SPAN))
    return rows


def _fenced(text: Column) -> Column:
    """The text with fences around all that the patterns match."""
    clean, put = F.translate(text, FENCE, " "), f"{FENCE}$0{FENCE}"
    return F.when(text.contains("@"), F.regexp_replace(clean, _ANY, put)).otherwise(F.regexp_replace(clean, _NUMBER, put))


def _is_fenced(token: Column) -> Column:
    return token.startswith(FENCE)


def _item(token: Column) -> Column:
    """An entity as FENCE kind:value, or a term."""
    inside = F.translate(token, FENCE, "")
    value = (
        F.when(inside.contains("@"), F.concat(F.lit("email:"), F.lower(inside)))
        .when(inside.startswith("+"), F.when(_valid("phone", inside), F.concat(F.lit("phone:"), _digits(inside))))
        .when(inside.contains("."), F.when(_valid("ip", inside), F.concat(F.lit("ip:"), inside)))
        .when(_valid("card", inside), F.concat(F.lit("card:"), _digits(inside)))
    )
    return F.when(_is_fenced(token), F.coalesce(F.concat(F.lit(FENCE), value), inside)).otherwise(token)


def _items(fenced: Column) -> Column:
    """All entities and terms of a text in turn."""
    words = F.regexp_extract_all(fenced, F.lit(_WORD), 0)
    return F.when(fenced.contains(FENCE), F.transform(F.regexp_extract_all(fenced, F.lit(_TOKEN), 0), _item)).otherwise(words)


def _passages(texts: DataFrame, passage: int, private: bool = False) -> DataFrame:
    """(doc, items): stretches of at most `passage` entities and words, with `private` of the texts that hold an entity;
    `doc` is the digest of the whole text."""
    rows = texts.withColumn("fenced", _fenced(F.col("text")))
    rows = rows.select(F.sha2("text", 256).alias("doc"), _items(F.col("fenced")).alias("all")).where(F.size("all") > 0)
    rows = rows.where(F.exists("all", lambda x: _is_fenced(x))) if private else rows
    cut = lambda x: F.transform(F.sequence(F.lit(0), F.size(x) - 1, F.lit(passage)), lambda i: F.slice(x, i + 1, passage))
    return rows.select("doc", F.explode(_let(F.col("all"), cut)).alias("items"))


def _terms(items: Column, one, two) -> Column:
    """The distinct words, as one(a), and pairs of neighbouring words, as two(a, b), of a passage."""

    def every(x: Column) -> Column:
        n = F.size(x) - 1
        return F.concat(F.transform(x, one), F.zip_with(F.slice(x, 1, n), F.slice(x, 2, n), two))

    def some(x: Column) -> Column:
        n = F.size(x) - 1
        free = F.transform(F.filter(x, lambda t: ~_is_fenced(t)), one)
        pairs = F.zip_with(F.slice(x, 1, n), F.slice(x, 2, n), lambda a, b: F.when(~_is_fenced(a) & ~_is_fenced(b), two(a, b)))
        return F.concat(free, F.filter(pairs, lambda p: p.isNotNull()))

    return _let(items, lambda x: F.array_distinct(F.when(F.exists(x, _is_fenced), some(x)).otherwise(every(x))))


def _as_text(items: str) -> Column:
    return _terms(F.col(items), lambda a: a, lambda a, b: F.concat(a, F.lit(PAIR), b))


def _as_number(items: str) -> Column:
    """Terms by hash, cheaper to compare."""
    return _terms(F.col(items), lambda a: F.xxhash64(a), lambda a, b: F.xxhash64(a, b))


def _number(term: str) -> Column:
    words = F.split(term, PAIR)
    return F.when(F.col(term).contains(PAIR), F.xxhash64(F.get(words, F.lit(0)), F.get(words, F.lit(1)))).otherwise(F.xxhash64(term))


def _minima(passages: DataFrame) -> DataFrame:
    """(doc, key, k, low): for each of 16 hashes the least over a passage's shingles, entities masked."""

    def lows(w: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1)))
        shingles = F.transform(places, lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))
        # A digest gives four hashes of 16 hexadecimal digits.
        digests = [F.transform(shingles, lambda s: F.sha2(F.concat(F.lit(f"{seed}:"), s), 256)) for seed in range(MINIMA // 4)]
        least = lambda d: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda n: F.array_min(F.transform(d, lambda x: x.substr(16 * n + 1, F.lit(16)))))
        return F.concat(*[_let(d, least) for d in digests])

    masked = F.transform("items", lambda x: F.when(_is_fenced(x), FENCE).otherwise(x))
    return passages.select("doc", "key", F.posexplode(_let(masked, lows)).alias("k", "low"))


def _spread_labels(minima: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    """(entity, key, label): of an entity's passages, the least label of all that share a minimum with one."""
    same = ["entity", "k", "low"]
    rows = minima.join(labels, ["entity", "key"])
    classes = materialize(rows.groupBy(*same).agg(F.min("label").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "privacy-classes")
    hot = F.col("n") * HOT_PARTS > total
    near = rows.join(F.broadcast(classes.where(hot)), same)
    cold = rows.join(F.broadcast(classes.where(hot).select(*same)), same, "left_anti").join(classes.where(~hot), same)
    found = near.select("entity", "key", "least").unionByName(cold.select("entity", "key", "least")).unionByName(labels.withColumnRenamed("label", "least"))
    return found.groupBy("entity", "key").agg(F.min("least").alias("label"))


def _witnesses(mentions: DataFrame, parts: DataFrame) -> DataFrame:
    """(entity, key, label): passages that copy one another, or stand in documents that do, share a label: they are one witness."""
    pairs = mentions.select("entity", "key", "doc")
    low = materialize(_minima(parts.join(pairs.select("doc").distinct(), "doc", "left_semi")), "privacy-lows")
    whole = low.groupBy("doc", (F.col("k") + MINIMA).alias("k")).agg(F.min("low").alias("low"))
    minima = pairs.drop("doc").join(low.drop("doc"), "key").unionByName(pairs.join(whole, "doc").drop("doc"))
    minima = materialize(minima, "privacy-minima")
    labels, total = pairs.select("entity", "key", F.col("key").alias("label")), pairs.count()
    for _ in range(2):
        labels = materialize(_spread_labels(minima, labels, total), "privacy-labels")
    return labels


def _share(total: float, n_term: str) -> Column:
    """PMI / IC; null for an entity that stands everywhere."""
    ic = F.log2(total / F.col("n_entity"))
    return F.log2(total * F.col("n_both") / (F.col("n_entity") * F.col(n_term))) / F.when(ic > 0, ic)


def _told(texts: DataFrame, threshold: float, passage: int) -> tuple[DataFrame, DataFrame]:
    """`disclosing_terms` of the column `text`, a pair's words on both sides of PAIR, and (doc) of the texts that hold any."""
    parts = _passages(texts.where(F.col("text").rlike(_ANY)), passage, private=True)
    parts = parts.withColumn("key", F.sha2(F.concat("doc", F.array_join("items", " ")), 256)).groupBy("key")
    parts = materialize(parts.agg(F.first("items").alias("items"), F.first("doc").alias("doc"), F.count(F.lit(1)).alias("copies")), "privacy-passages")
    private = parts.where(F.exists("items", lambda x: _is_fenced(x)))
    mentions = private.select("key", "doc", "copies", F.explode(F.array_distinct(F.filter("items", _is_fenced))).alias("entity"))
    # Entities in several passages first, then in several that are no near copies.
    often = mentions.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("n_entity")).where("n > 1").drop("n")
    mentions = materialize(mentions.join(often, "entity"), "privacy-mentions")
    labelled = materialize(mentions.join(_witnesses(mentions, parts), ["entity", "key"]), "privacy-labelled")
    apart = F.min("label") != F.max("label")
    live = labelled.groupBy("entity").agg(apart.alias("apart")).where("apart").select("entity")
    held = labelled.join(live, "entity").groupBy("key").agg(F.collect_set(F.struct("entity", "n_entity", "label")).alias("held"))
    together = held.join(private, "key").select("copies", F.explode("held").alias("h"), "items")
    together = together.select("copies", "h.*", F.explode(_as_text("items")).alias("term"))
    both = together.groupBy("entity", "n_entity", "term").agg(F.sum("copies").alias("n_both"), apart.alias("apart")).where("apart").drop("apart")
    both = materialize(both.withColumn("number", _number("term")), "privacy-both")
    # Terms that are too frequent in these passages alone, were there as many passages as the texts' lengths allow, need no count.
    at_most = texts.agg(F.sum(1 + F.length("text") / passage)).first()[0] or 0
    seen = private.select("copies", F.explode(_as_number("items")).alias("number")).join(both.select("number").distinct(), "number")
    both = both.join(seen.groupBy("number").agg(F.sum("copies").alias("n_seen")), "number")
    both = materialize(both.where(_share(float(at_most), "n_seen") >= threshold).drop("n_seen"), "privacy-rare")
    # A number of its own counts the passages.
    every = F.lit(0).cast("bigint")
    wanted = materialize(both.select("number").unionByName(texts.sparkSession.range(1).select(every.alias("number"))).distinct(), "privacy-wanted")
    hits = _passages(texts, passage).select("doc", F.explode(F.array_append(_as_number("items"), every)).alias("number"))
    hits = materialize(hits.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_TERMS else wanted, "number"), "privacy-hits")
    counts = hits.groupBy("number").agg(F.count(F.lit(1)).alias("n_term"))
    total = float(hits.where("number = 0").count())
    told = materialize(both.join(counts, "number").withColumn("share", _share(total, "n_term")).where(F.col("share") >= threshold), "privacy-disclosing")
    pair = F.col("term").contains(PAIR)
    single = told.where(~pair).select("entity", F.col("term").alias("word"))
    rest = told.where(pair)
    for k in (1, -1):
        rest = rest.withColumn("word", F.element_at(F.split("term", PAIR), k)).join(single, ["entity", "word"], "left_anti")
    told = materialize(told.where(~pair).unionByName(rest.select(*told.columns)), "privacy-told")
    return told, hits.join(told.select("number").distinct(), "number", "left_semi").select("doc").distinct()


def disclosing_terms(docs: DataFrame, text: str = "text", threshold: float = 0.75, passage: int = 1000) -> DataFrame:
    """(entity, term, n_both, n_entity, n_term, share): terms that disclose an entity; counts are of passages, share is PMI / IC.

    A pair of words is left out where one of its words discloses the same entity. An entity that stands in one document
    or its near copies only has no terms, nor has one that stands in every passage. Null texts are empty; rows that
    repeat a text count each; an empty table gives no rows; other columns are ignored.
    """
    texts = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    shown = {"entity": F.translate("entity", FENCE, ""), "term": F.translate("term", PAIR, " ")}
    return _told(texts, threshold, passage)[0].withColumns(shown).select("entity", "term", "n_both", "n_entity", "n_term", "share")


def _term_spans(texts: DataFrame, terms: DataFrame, hit: DataFrame) -> DataFrame:
    """(doc, terms): for each of the texts that hold disclosing terms, their spans with the greatest share."""
    rows = texts.withColumn("doc", F.sha2("text", 256)).join(hit, "doc", "left_semi")
    rows = rows.groupBy("doc").agg(F.first("text").alias("text")).withColumn("fenced", _fenced(F.col("text")))
    rows = _with_places(rows, "fenced", _TOKEN, "tokens", lambda m: F.length(m) - F.when(_is_fenced(m), 2).otherwise(0), F.lit(True))
    items = F.transform("tokens", lambda x: F.struct(_item(x["match"]).alias("term"), x["start"].alias("start")))
    end = lambda x: x["start"] + F.length(x["term"])
    spot = lambda term, a, b: F.struct(term.alias("term"), a["start"].alias("start"), end(b).alias("end"))
    free = lambda x: ~_is_fenced(x["term"])
    joined = lambda a, b: F.when(b.isNotNull() & free(a) & free(b), spot(F.concat(a["term"], F.lit(PAIR), b["term"]), a, b))
    pairs = lambda x: F.zip_with(x, F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), joined)
    every = _let(items, lambda x: F.concat(F.transform(F.filter(x, free), lambda t: spot(t["term"], t, t)), F.filter(pairs(x), lambda p: p.isNotNull())))
    spots = rows.select("doc", F.inline(every))
    found = spots.join(terms.select("term", "share"), "term").groupBy("doc", "start", "end").agg(F.max("share").alias("share"))
    return found.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end", "share"))).alias("terms"))


def private_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.75, remove: float = 0.9, passage: int = 1000) -> DataFrame:
    """(doc_id, email, ip, card, phone, terms) for every row: arrays of spans (kind, start, end) in code points.

    The kinds of `terms` are `removed` and `generalised`. A null or empty text has none; rows that repeat ids or texts each
    have theirs; a null id stays null; an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    texts = rows.select("text")
    told, hit = _told(texts, threshold, passage)
    terms = told.groupBy("term").agg(F.max("share").alias("share"))
    spans = materialize(_term_spans(texts, terms, hit), "privacy-term-spans")
    found = base_spans(rows.withColumn("doc", F.sha2("text", 256))).drop("text")
    none = F.array().cast(SPAN)
    kind = lambda s: F.when(s["share"] >= remove, "removed").otherwise("generalised")
    said = F.transform("terms", lambda s: F.struct(kind(s).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.join(spans, "doc", "left").select("doc_id", *PATTERNS, F.coalesce(said, none).alias("terms"))


def sanitise(text: Column, spans: Column) -> Column:
    """The text with its spans (kind, start, end) replaced: personal data by its kind, a generalised term by the class
    of its form, a removed one by nothing. Of spans that overlap, the one that begins first (then the longest) counts."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<gap: bigint, start: bigint, end: bigint, kind: string>>").alias("kept"))

    def add(done: Column, s: Column) -> Column:
        one = F.struct(done["at"].alias("gap"), s["start"].alias("start"), (-s["back"]).alias("end"), s["kind"].alias("kind"))
        return F.when(s["start"] >= done["at"], F.struct((-s["back"]).alias("at"), F.array_append(done["kept"], one).alias("kept"))).otherwise(done)

    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), 0)
    done = F.aggregate(order, first, add)

    def part(p: Column, a: Column, b: Column) -> Column:
        def piece(k: Column) -> Column:
            begin = F.greatest(a - k * BLOCK, F.lit(0))
            return F.get(p["blocks"], k.cast("int")).substr((begin + 1).cast("int"), F.greatest(F.least(b - k * BLOCK, F.lit(BLOCK)) - begin, F.lit(0)).cast("int"))

        inside = F.array_join(F.transform(F.sequence(F.floor(a / BLOCK), F.floor((b - 1) / BLOCK)), piece), "")
        return F.when(b > a, inside).otherwise("")

    def shown(p: Column, s: Column) -> Column:
        was = part(p, s["start"], s["end"])
        form = F.when(was.rlike("[0-9]"), "[CODE]").when(was.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
        return F.concat(part(p, s["gap"], s["start"]), F.when(s["kind"] == "removed", "").when(s["kind"] == "generalised", form).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))

    whole = F.array(F.struct(blocks.alias("blocks"), done.alias("done"), F.length(text).cast("bigint").alias("n")))
    return F.element_at(F.transform(whole, lambda p: F.concat(F.array_join(F.transform(p["done"]["kept"], lambda s: shown(p, s)), ""), part(p, p["done"]["at"], p["n"]))), 1)


def private_digests(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of personal data, a digest of its spans and all spans as kind:start:end; disclosing terms are of kind `term`."""
    rows = private_spans(docs, id, text)
    said = lambda spans, kind: F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string")))
    base = said(F.concat(*PATTERNS), lambda s: s["kind"])
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in PATTERNS]
    every = F.concat(base, said("terms", lambda s: F.lit("term")))
    return rows.select("doc_id", *counts, F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(every, ",").alias("spans"))
