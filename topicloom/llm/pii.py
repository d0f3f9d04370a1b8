"""Personal data: fixed patterns, and terms that give a protected entity away.

DataFrame functions only. The patterns find e-mail and IP addresses, card and phone numbers; each found
value is a protected entity. The information-theoretic part asks which terms disclose an entity. A
line's context is the line and its two neighbours. A term t and an entity e that share contexts have the
pointwise mutual information log2(N * n(t, e) / (n(t) * n(e))), at most the entity's information content
log2(N / n(e)), which it reaches if t appears with e only. A term whose share of that content is DISCLOSURE
or more, and whose meetings with e are no chance, is a span of its own
wherever it stands in a document that holds e. No chance means: were e's d different lines (a copied line counts
once: a copy is no evidence; what base spans hold is blank) drawn from all lines, x or more of them would have t with a probability of
exp(-d KL(x/d || n(t)/N)) at most, and that times the number of term and line pairs looked at is CHANCE at
most. So no number of lines is fixed: two lines suffice for a rare term, and one does where entities are
so rare that a coincidence is not expected. Sanitising generalises entities to their kind and removes
disclosing terms.

Positions, blanks and sanitised texts come from running sums and maxima over chunks of CHUNK matches, so that
time grows with a text's matches and not with their square. The patterns match within lines, so lines that
could hold an entity are read by themselves, each beside its neighbours.

Patterns are written so that Java's matcher neither recurses nor rescans: possessive where nothing can
be given back, and starting only where the leftmost match can start (after \\G too, as a match may end
inside a run). Positions are code points, the end exclusive.

Null texts count as empty; a null doc_id has base spans, and terms too. Equal rows give equal results. An
empty table gives an empty result; further columns are ignored by `spans`, kept by `sanitised`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import cut, fenced

KINDS = ("email", "ip", "card", "phone")
DISCLOSURE, CHANCE, BROADCAST_ROWS, CHUNK = 0.75, 0.01, 20_000, 256
#: Numbers of buckets of terms: so many of them may be broadcast.
BUCKETS = 1 << 19
#: What the contract's patterns match, for Java.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A pattern is only tried on a text that has one of these.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM = r"\p{L}{3,}+"


def _matches(text: str, pattern: str, when: Column) -> tuple[Column, Column]:
    """What stands between matches, and the matches: both, with their lengths, give positions."""
    return F.when(when, F.split(text, pattern, -1)), F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _let(value: str, name: str, body: str) -> str:
    """body, in which name stands for value, computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _chunks(size: str) -> str:
    return f"sequence(0, ({size} - 1) div {CHUNK})"


def _before(values: str, size: str, join: str) -> str:
    """Of an array of bigints what those before each come to; join, of (x, y), is their sum or maximum."""
    both = lambda x, y: join.replace("x", x).replace("y", y)
    none = "cast(array() as array<bigint>)"
    local = f"transform({_chunks(size)}, c -> aggregate(slice({values}, c * {CHUNK} + 1, {CHUNK}), struct(0L as at, {none} as found), (a, v) -> struct({both('a.at', 'v')} as at, concat(a.found, array(a.at)) as found)))"
    bases = f"aggregate(_l, struct(0L as at, {none} as found), (a, p) -> struct({both('a.at', 'p.at')} as at, concat(a.found, array(a.at)) as found), a -> a.found)"
    return _let(local, "_l", _let(bases, "_b", f"flatten(transform(_l, (p, c) -> transform(p.found, v -> {both('v', 'get(_b, c)')})))"))


def _place(parts: str, matches: str) -> Column:
    """Structs (s, e, value) of the matches in order."""
    steps = f"transform({matches}, (m, k) -> cast(length(get({parts}, k)) + length(m) as bigint))"
    s = f"get(_at, k) + length(get({parts}, k))"
    body = f"transform({matches}, (m, k) -> struct({s} as s, {s} + length(m) as e, m as value))"
    return F.expr(_let(steps, "_s", _let(_before("_s", "size(_s)", "(x + y)"), "_at", body)))


def _rewritten(text: str, spans: str, mark: str) -> Column:
    """text with `mark` (of the span x and the place `at`, up to which is written) in place of each of the spans (s, e, ...), which are in order; what several hold is written once."""
    ends = f"transform({spans}, x -> x.e)"
    piece = f"concat(substring(_part, cast(at - _from + 1 as int), cast(greatest(x.s - at, 0L) as int)), {mark})"
    pieces = f"array_join(transform(slice({spans}, c * {CHUNK} + 1, {CHUNK}), (x, k) -> {_let(f'get(_at, c * {CHUNK} + k)', 'at', piece)}), '')"
    part = f"substring({text}, cast(_from + 1 as int), cast(coalesce(get(_at, (c + 1) * {CHUNK}), _end) - _from as int))"
    chunk = _let(f"get(_at, c * {CHUNK})", "_from", _let(part, "_part", pieces))
    whole = f"concat(array_join(transform({_chunks(f'size({spans})')}, c -> {chunk}), ''), substring({text}, cast(_end + 1 as int)))"
    return F.expr(_let(_before(ends, f"size({spans})", "greatest(x, y)"), "_at", _let(f"array_max({ends})", "_end", whole)))


def _on(test, kind: str):
    return lambda x: test(kind, x["value"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    places = F.split(F.reverse(digits), "")
    double = lambda d: F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
    each = F.transform(F.filter(places, lambda c: c != ""), lambda c, i: F.when(i % 2 == 1, double(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def with_base_spans(docs: DataFrame) -> DataFrame:
    """docs with a column for each kind: array of structs (s, e, value)."""
    rows = docs.withColumn("_text", F.coalesce(docs["text"].cast("string"), F.lit("")))
    none = F.expr("cast(array() as array<struct<s:bigint,e:bigint,value:string>>)")
    rows = rows.withColumn("_numbers", F.col("_text").rlike("[0-9]"))
    for kind in KINDS:
        there = F.col("_text").contains(HINTS[kind]) if HINTS[kind] else F.lit(True)
        there = there & F.col("_numbers") if kind != "email" else there
        parts, matches = _matches("_text", PATTERNS[kind], there)
        rows = rows.withColumns({"_p": parts, "_m": matches}).withColumn("_found", F.when(F.size("_m") > 0, _place("_p", "_m")))
        rows = rows.withColumn(f"_{kind}", F.coalesce(F.filter("_found", _on(_valid, kind)), none)).drop("_p", "_m", "_found")
    return fenced(rows.drop("_numbers"), [f"_{k}" for k in KINDS])


def _entity(kind: str, value: Column) -> Column:
    value = F.lower(value) if kind == "email" else _digits(value) if kind in ("card", "phone") else value
    return F.concat(F.lit(f"{kind}:"), value)


def _terms(line: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(line, F.lit(TERM), F.lit(0)), F.lower))


def _cleared(rows: DataFrame) -> DataFrame:
    """rows with _clear: the text with its base spans blank, so that parts of a value are no terms beside it but the same words in the prose are."""
    rows = rows.withColumn("_found", F.sort_array(F.concat(*[F.col(f"_{k}") for k in KINDS])))
    blank = _rewritten("_text", "_found", "repeat(' ', cast(x.e - greatest(x.s, at) as int))")
    return fenced(rows.withColumn("_clear", F.when(F.size("_found") > 0, blank).otherwise(F.col("_text"))), ["_clear"]).drop("_found")


def _contexts(rows: DataFrame, text: str) -> DataFrame:
    """rows with _near: of each line that isn't empty the terms of the line and its neighbours."""
    rows = fenced(rows.withColumn("_lines", F.transform(F.filter(F.split(text, "\n"), lambda x: x != ""), _terms)), ["_lines"])
    near = F.expr("transform(_lines, (x, k) -> array_distinct(flatten(slice(_lines, greatest(k, 1), if(k = 0, 2, 3)))))")
    return fenced(rows.withColumn("_near", near), ["_near"]).drop("_lines")


def _unlikely(x: Column, d: Column, q: Column, bound: float) -> Column:
    """Whether x or more of d draws hit, at a rate of q, with a probability of bound at most (Chernoff's)."""
    rate = x / d
    rest = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - q))).otherwise(0.0)
    return (rate > q) & (-d * (rate * F.log(rate / q) + rest) <= math.log(bound))


def _holding_lines(docs: DataFrame) -> DataFrame:
    """(h, entities, terms) of each line with an entity: the line's digest, and the terms of it and its neighbours."""
    lines = docs.select(F.filter(F.split(F.coalesce(docs["text"].cast("string"), F.lit("")), "\n"), lambda x: x != "").alias("_l"))
    around = F.expr("transform(filter(sequence(0, size(_l) - 1), k -> size(_l) > 0 and get(_l, k) rlike '[0-9@]'), k -> struct(array(get(_l, k), get(_l, k - 1), get(_l, k + 1)) as texts))")
    lines = lines.select(F.explode(around).alias("x")).select("x.texts", F.monotonically_increasing_id().alias("id"))
    line = with_base_spans(lines.select("id", "texts", F.col("texts")[0].alias("text")))
    entities = F.array_distinct(F.concat(*[F.transform(f"_{k}", _on(_entity, k)) for k in KINDS]))
    line = fenced(_cleared(line).select("texts", "_clear", entities.alias("entities")), ["entities"]).where(F.size("entities") > 0)
    line = line.select("texts", "entities", F.col("_clear").alias("clear0"))
    for k in (1, 2):  # neighbours, each blank where it holds values of its own
        beside = with_base_spans(line.withColumn("text", F.col("texts")[k]))
        line = _cleared(beside).select(*line.columns, F.col("_clear").alias(f"clear{k}"))
    terms = F.array_distinct(F.flatten(F.array(*[_terms(F.col(f"clear{k}")) for k in range(3)])))
    return line.select(F.xxhash64(F.col("texts")[0]).alias("h"), "entities", terms.alias("terms"))


def _few(df: DataFrame) -> DataFrame:
    """df for a join: broadcast if it was counted and is small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def disclosing(docs: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """(entity, term) pairs whose term discloses the entity, over all lines of docs."""
    held = cut(_holding_lines(docs))
    each = held.select("h", F.size("terms").alias("terms"), F.explode("entities").alias("entity"))
    by_line = each.groupBy("entity", "h").agg(F.count(F.lit(1)).alias("n"), F.max("terms").alias("terms"))
    known = cut(by_line.groupBy("entity").agg(F.sum("n").alias("n_e"), F.count(F.lit(1)).alias("d"), F.sum("terms").alias("looked")))
    looked = known.agg(F.sum("looked")).head()[0] or 0
    if not looked:
        return known.select("entity", F.lit("").alias("term")).limit(0)
    n = float(docs.select(F.size(F.filter(F.split(F.coalesce(docs["text"].cast("string"), F.lit("")), "\n"), lambda x: x != "")).alias("n")).agg(F.sum("n")).head()[0])
    # an entity, then a term, goes no further if it could not pass even with as few lines as it has itself
    bound = min(chance / looked, 1.0)
    able = cut(known.where(_unlikely(F.col("d"), F.col("d"), F.col("d") / n, bound)).select("entity", "n_e", "d"))
    # only then do the lines' terms travel, each line once for an entity that may pass
    beside = _few(able.select("entity"))
    alive = held.select("h", "terms", F.explode("entities").alias("entity")).join(beside, "entity", "left_semi")
    shared = alive.select("entity", "h", F.explode("terms").alias("term"))
    shared = shared.groupBy("entity", "term", "h").agg(F.count(F.lit(1)).alias("n")).groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("x"))
    shared = cut(shared.join(able, "entity").where(_unlikely(F.col("x"), F.col("d"), F.col("x") / n, bound)))
    candidates = cut(shared.select("term").distinct())
    if candidates.isEmpty():
        return shared.select("entity", "term")
    totals = _contexts(_cleared(with_base_spans(docs.select("text"))).select("_clear"), "_clear").select(F.explode("_near").alias("terms")).select(F.explode("terms").alias("term"))
    if candidates.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        totals = totals.join(F.broadcast(candidates), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    else:  # terms of other buckets go at once, the rest is counted before it is shuffled
        bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS))
        totals = totals.join(F.broadcast(candidates.select(bucket.alias("bucket")).distinct()), bucket == F.col("bucket"), "left_semi")
        totals = totals.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(candidates, "term", "left_semi")
    scored = shared.join(totals, "term").where(_unlikely(F.col("x"), F.col("d"), F.col("n_t") / n, bound))
    content = F.log2(F.lit(n) / F.col("n_e"))
    information = F.log2(F.lit(n) * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    return scored.where((content > 0) & (information >= disclosure * content)).select("entity", "term")


def with_spans(docs: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """docs with the base kinds' columns and _term: the places of disclosing terms."""
    found = cut(disclosing(docs, disclosure, chance))
    rows = with_base_spans(docs)
    none = F.expr("cast(array() as array<struct<s:bigint,e:bigint,value:string>>)")
    if found.isEmpty():
        return rows.withColumn("_term", none)
    by_entity = found.groupBy("entity").agg(F.collect_set("term").alias("terms"))
    # rows are named by the digest of their text: ids may repeat or be null
    texts = rows.withColumn("_key", F.xxhash64("_text"))
    entities = F.array_distinct(F.concat(*[F.transform(f"_{k}", _on(_entity, k)) for k in KINDS]))
    holders = with_base_spans(docs.select("text")).select(F.xxhash64("_text").alias("_key"), F.explode(entities).alias("entity")).distinct()
    terms = holders.join(by_entity, "entity").groupBy("_key").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("_terms"))
    texts = texts.join(_few(cut(terms)), "_key", "left")
    texts = _cleared(texts)  # blanks keep places, so what is found there overlaps no base span
    parts, matches = _matches("_clear", TERM, F.col("_terms").isNotNull())
    texts = texts.withColumns({"_p": parts, "_m": matches}).withColumn("_found", F.when(F.size("_m") > 0, _place("_p", "_m")))
    inside = F.expr("filter(_found, x -> array_contains(_terms, lower(x.value)))")
    return texts.withColumn("_term", F.coalesce(inside, none)).drop("_p", "_m", "_found", "_clear", "_terms", "_key")


def _listed(kind: str) -> Column:
    return F.transform(f"_{kind}", lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string")))


def _marked(kind: str) -> Column:
    by = F.lit("" if kind == "term" else f"[{kind.upper()}]")
    return F.transform(f"_{kind}", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), by.alias("by")))


def spans(docs: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term of each row."""
    rows = with_spans(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), disclosure, chance)
    base = F.array_join(F.concat(*[_listed(k) for k in KINDS]), ",")
    everything = F.array_join(F.concat(*[_listed(k) for k in (*KINDS, "term")]), ",")
    return rows.select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(base, 256).alias("base_sha256"), everything.alias("spans"), F.size("_term").cast("long").alias("n_term"))


def sanitised(docs: DataFrame, disclosure: float = DISCLOSURE, chance: float = CHANCE) -> DataFrame:
    """docs with every entity's text generalised to [EMAIL], [IP], [CARD] or [PHONE] and disclosing terms removed; n_chars follows. Of spans that overlap, the first in the text (the longer, if they start together) is written."""
    # the row travels in one column, so that no name of its own meets one of the work's
    rows = with_spans(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), docs["text"].alias("text")), disclosure, chance)
    marked = F.concat(*[_marked(k) for k in (*KINDS, "term")])
    rows = rows.withColumn("_marked", F.sort_array(marked))
    rows = rows.withColumn("_marked", F.transform("_marked", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["by"].alias("by"))))
    written = _rewritten("_text", "_marked", "if(x.s >= at, x.by, '')")
    changed = F.size("_marked") > 0
    rows = rows.withColumn("_written", F.when(changed, written).otherwise(F.col("text")))
    new = F.col("_row").withField("text", F.col("_written"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.when(changed, F.length("_written").cast("long")).otherwise(F.col("_row.n_chars")))
    return rows.select(new.alias("_row")).select("_row.*")
