"""Personal data: base patterns, and information-theoretic sanitisation of the terms that give it away.

DataFrame functions only. Positions of pattern matches come from the text split at the pattern: a match starts
after all segments and matches before it.

A term discloses a protected entity (an e-mail address, phone number, card or IP address found by the patterns)
when the corpus shows that whoever reads the term can tell the entity. All is counted in distinct texts, so that
copies count once. Of a term in ``df`` texts, ``joint`` of them with the term among the words around entity e,
the information it discloses is ``log2(P(e | term) / P(e))``. Terms with ``P(e | term) >= reveal``, at least
``bits`` of information and ``support`` distinct contexts (the words around a mention) exceed the threshold:
wherever they occur they are removed, or generalised to their kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marajo.llm.shared import maybe, with_bitmap
from marajo.session import stash

#: Patterns by kind, in order of report. Each matches what the plain pattern in its comment matches from left to
#: right; possessive repeats and start conditions keep long runs linear and off the stack.
KINDS: dict[str, str] = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Terms (of at most 100 bytes on average) that may be sent to every executor, and that may stand in a filter.
BROADCAST_TERMS, FEW_TERMS = 50_000, 1000
#: Matches that are appended to one array before a new one is begun.
PACK = 128
_SPAN = "struct<kind:string,start:int,end:int,value:string,around:array<string>>"
_SPACE = r"[ \t\n\x0B\f\r]++"
_WORD_CLASS = r"[^ \t\n\x0B\f\r]"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return total + twice

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255
        )
    digits = _digits(match)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def located(text: Column, pattern: Column, valid=None, places: bool = False) -> Column:
    """Array of (start, end, value) of the pattern's matches from left to right, in code points, end exclusive.

    ``valid`` (a condition on the value) says which matches are reported. With ``places`` each also has ``before``, the
    number of words that end before it, and ``upto``, that of words that start before its end. Matches are gathered in
    packs of ``PACK``, so the work is linear in the text but for one small append in ``PACK``.
    """
    fields = "start:int,end:int,value:string" + (",before:int,upto:int" if places else "")
    none = F.array().cast(f"array<struct<{fields}>>")
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("words"), F.lit(False).alias("inside"), none.alias("pack"), F.array().cast(f"array<array<struct<{fields}>>>").alias("full")
    )

    def words_after(words: Column, inside: Column, part: Column) -> tuple[Column, Column]:
        """Words begun, and whether the last one goes on, after another part of the text."""
        fresh = F.regexp_count(part, F.lit(_WORD_CLASS + "+")) - (inside & part.rlike("^" + _WORD_CLASS)).cast("int")
        return words + fresh, F.when(part == "", inside).otherwise(part.rlike(_WORD_CLASS + "\\z"))

    def add(a: Column, x: Column) -> Column:
        value = x["value"]
        begin = a["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(value), F.lit(0))
        words, inside = a["words"], a["inside"]
        extra = []
        if places:
            words, inside = words_after(words, inside, x["gap"])
            before = (words - inside.cast("int")).alias("before")
            words, inside = words_after(words, inside, F.coalesce(value, F.lit("")))
            extra = [before, words.alias("upto")]
        item = F.array(F.struct(begin.alias("start"), end.alias("end"), value.alias("value"), *extra))
        good = value.isNotNull() if valid is None else value.isNotNull() & F.coalesce(valid(value), F.lit(False))
        last = F.size(a["pack"]) >= PACK - 1
        return F.struct(
            end.alias("at"), words.alias("words"), inside.alias("inside"),
            F.when(~good, a["pack"]).when(last, none).otherwise(F.concat(a["pack"], item)).alias("pack"),
            F.when(good & last, F.concat(a["full"], F.array(F.concat(a["pack"], item)))).otherwise(a["full"]).alias("full"),
        )

    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("value"))
    return F.aggregate(pairs, start, add, lambda a: F.flatten(F.concat(a["full"], F.array(a["pack"]))))


def _base_spans(text: Column, kind: str, reach: int) -> Column:
    """Valid matches of a kind, with the kind and the words around each; none where the text lacks the kind's telling
    character."""
    telling = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
    pattern, valid = F.lit(KINDS[kind]), lambda value: _valid(kind, value)

    def told(words: Column) -> Column:
        return F.transform(
            located(text, pattern, valid, places=True),
            lambda m: F.struct(
                F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"),
                F.concat(
                    F.slice(words, F.greatest(m["before"] - (reach - 1), F.lit(1)), F.least(m["before"], F.lit(reach))), F.slice(words, m["upto"] + 1, F.lit(reach))
                ).alias("around"),
            ),
        )

    none = F.array().cast(f"array<{_SPAN}>")
    likely = text.rlike(KINDS[kind]) if telling is None else F.contains(text, F.lit(telling)) & text.rlike(KINDS[kind])
    return F.when(likely & (F.size(located(text, pattern, valid)) > 0), _bind(_words(text), told)).otherwise(none)


def mentions(docs: DataFrame, reach: int = 8) -> DataFrame:
    """``doc_id``, ``tag`` (hash of the text) and ``base``: spans (kind, start, end, value) by kind, then start, each
    with ``around``: up to ``reach`` whole words on either side that the span doesn't touch."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("tag"), F.concat(*[_base_spans(F.col("text"), k, reach) for k in KINDS]).alias("base"))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def _are_few(terms: DataFrame) -> bool:
    """Whether ``terms`` (one written column) are few and short enough to be sent to every executor."""
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(terms.columns[0])).alias("bytes")).first()
    return size.n <= BROADCAST_TERMS and (size.bytes or 0) <= 100 * max(BROADCAST_TERMS, 0)


def _small(terms: DataFrame) -> DataFrame:
    """``terms`` marked for broadcast where they are few; else left to a shuffled join."""
    return F.broadcast(terms) if _are_few(terms) else terms


def disclosing_terms(docs: DataFrame, found: DataFrame, support: int = 3, reveal: float = 0.5, bits: float = 8.0) -> DataFrame:
    """``term``, ``kind``, ``entity``, ``information`` of the terms beyond the thresholds, the most telling entity each
    (of equally telling ones that of the last kind and value).

    ``found`` is ``mentions(docs)``, written. Terms are words of two characters or more without digits or ``@`` that
    stand in the words around a mention; all is counted in distinct texts, null ids and repeated rows included. A term
    stands in at least as many texts as there are texts that have it around some mention, so most terms fall before
    the corpus is counted, and only words that are candidates leave the scan that counts them, or, where candidates are too
    many to be sent, that a bitmap of them lets pass. No text is ever moved. An empty table has no terms.
    """
    contexts = found.select("tag", F.explode("base").alias("m")).select("tag", "m.kind", F.col("m.value").alias("entity"), "m.around").distinct()
    total = contexts.groupBy("kind", "entity").agg(F.count_distinct("tag").alias("mentions"))
    size = max(found.agg(F.count_distinct("tag").alias("n")).first().n, 1)
    term = F.col("term")
    near = contexts.select("tag", "kind", "entity", F.xxhash64("around").alias("place"), F.explode(F.array_distinct("around")).alias("term"))
    near = near.where((F.length(term) > 1) & ~term.rlike("[0-9@]"))
    pairs = near.groupBy("kind", "entity", "term").agg(F.count_distinct("tag").alias("joint"), F.count_distinct("place").alias("places"))
    least = near.groupBy("term").agg(F.count_distinct("tag").alias("least"))
    chance = F.col("mentions") / F.lit(size)
    most = F.col("joint") / F.col("least")  # what P(entity given term) can be at most
    pairs = pairs.where(F.col("places") >= support).join(total, ["kind", "entity"]).join(least, "term")
    pairs = stash(pairs.where((most >= reveal) & (F.log2(most / chance) >= bits)), "term-pairs")
    told = pairs.select("term", "kind", "entity").limit(0).withColumn("information", F.lit(0.0))
    if pairs.isEmpty():
        return told
    candidates = stash(pairs.select("term").distinct(), "candidates")
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("tag"), F.array_distinct(_words(text)).alias("words"))
    if not _are_few(candidates):  # a bitmap of them keeps the other words in the row
        texts = with_bitmap(texts, candidates).select("tag", F.filter("words", maybe).alias("words"))
    corpus = texts.select("tag", F.explode("words").alias("term"))
    frequency = corpus.join(_small(candidates), "term").groupBy("term").agg(F.count_distinct("tag").alias("df"))
    given = F.col("joint") / F.col("df")
    telling = pairs.join(frequency, "term").select("term", "kind", "entity", given.alias("given"), F.log2(given / chance).alias("information"))
    telling = telling.where((F.col("given") >= reveal) & (F.col("information") >= bits))
    order = F.struct("information", "kind", "entity")
    return telling.groupBy("term").agg(F.max(order).alias("m")).select("term", "m.kind", "m.entity", "m.information")


def _term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term_key`` (id and tag of a text) and ``terms``: the spans of the words that are in ``terms``, where there are any."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    few = [r.term for r in terms.limit(FEW_TERMS + 1).collect()]
    places = located(F.col("text"), F.lit(_WORD_CLASS + "++"))
    if len(few) <= FEW_TERMS:  # spares the other texts the explosion
        texts = texts.where(F.exists(_words(F.col("text")), lambda w: w.isin(few)))
    else:  # and a bitmap spares all but a few of the other words it
        texts = with_bitmap(texts, terms).where(F.exists(_words(F.col("text")), maybe))
        places = F.filter(places, lambda m: maybe(m["value"]))
    words = texts.select("doc_id", "tag", F.explode(places).alias("m"))
    hits = words.select("doc_id", "tag", "m", F.col("m.value").alias("term")).join(_small(terms), "term", "left_semi")
    own = F.sort_array(F.collect_set(F.struct("m.start", "m.end", "m.value")))
    spans = F.transform("own", lambda m: F.struct(F.lit("term").alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))
    return hits.groupBy("doc_id", "tag").agg(own.alias("own")).select(F.struct("doc_id", "tag").alias("term_key"), spans.alias("terms"))


def find(docs: DataFrame, reach: int = 8, **limits) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every row of ``docs``: the base spans and, after them, one span of kind
    ``term`` for each occurrence of a disclosing term, by kind, then start.

    Null texts count as empty and have none. Rows that repeat an id and a text each come back with the same
    spans; a null id keeps its row. Equal spans of different kinds all stay. Other columns are not read; an empty
    table gives no rows. ``limits`` are those of :func:`disclosing_terms`. Only ids, hashes and spans are moved, never
    texts.
    """
    found = stash(mentions(docs, reach), "mentions")
    terms = stash(disclosing_terms(docs, found, **limits).select("term").distinct(), "terms")
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    found = found.select("doc_id", "tag", base.alias("base"))
    if terms.isEmpty():
        return found.select("doc_id", "tag", "base", F.col("base").alias("spans"))
    return found.join(_term_spans(docs, terms), F.struct("doc_id", "tag") == F.col("term_key"), "left").select(
        "doc_id", "tag", "base", F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.concat("base", "terms")).alias("spans")
    )


def sanitise(docs: DataFrame, generalise: bool = True, **limits) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets, or removed; other columns as they were.

    Overlapping spans are replaced together, under the kind of the first. Texts without spans, null among them, stay,
    rows without an id are treated like any other, repeated rows alike. An empty table gives no rows.
    """
    hit = find(docs, **limits).where(F.size("spans") > 0).distinct()
    hit = hit.select(F.struct("doc_id", "tag").alias("hit_key"), F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"]))).alias("hit_spans"))
    packed = docs.select(F.struct(*docs.columns).alias("row"))  # no column of theirs can clash
    own = F.struct(F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64("row.text").alias("tag"))
    joined = packed.join(hit, own == F.col("hit_key"), "left")
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(a: Column, s: Column) -> Column:
        mark = F.concat(F.lit("<"), s["kind"], F.lit(">")) if generalise else F.lit("")
        fresh = F.concat(a["out"], F.substr(text, a["at"] + 1, s["start"] - a["at"]), mark)
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], fresh).otherwise(a["out"]).alias("out"))

    clean = F.aggregate("hit_spans", start, add, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))
    mended = F.when(F.col("hit_spans").isNull(), text).otherwise(clean)
    return joined.select(*[(mended if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
