"""Personal data: base patterns with exact spans, and bootstrapped contextual extraction.

Everything runs on DataFrame functions. Base spans are seeds. The one and the two words right before and after
seeds are lexical patterns; a bipartite graph of patterns and instances (seeds and loosely shaped
candidates) is scored in rounds until nothing changes: a pattern by how many of its occurrences in the whole
corpus stand at accepted instances, an instance by the best patterns on its two sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.llm.common import broadcast_if_small, settle, text_or_empty

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: Base expressions. They are those of the contract, with runs taken whole: a match starts where the last
#: one ended or where no character of the first run stands before, which keeps the time linear.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to have a valid span of the kind.
BASE_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}[0-9]", "phone": r"\+[0-9]"}
#: Shapes that a candidate may have besides; accepted only in a trusted context.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\s?(?:\(at\)|\[at\]|\{at\}|\sat\s)\s?[A-Za-z0-9-]++(?:\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[.-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{2,4}\)?[\x20./-]?[0-9]{3}[\x20.-][0-9]{3,4}(?:[\x20.-]?[0-9]{2,4})?(?![0-9])",
}
#: What a text must hold before the loose shape is tried.
LOOSE_HINT = {"email": r"[(\[{\s]at[)\]}\s]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9]{4}[.-]?[0-9]{4}", "phone": r"[0-9]{3}[\x20.-][0-9]{3}"}
#: Distinct instances and share of occurrences that a pattern needs; trust that an instance needs.
SUPPORT, SHARE, TRUST = 3, 0.5, 0.6
#: Elements of an array that are walked at once: copies of what is found so far stay short.
CHUNK = 64

_INSTANCE = "array<struct<start:int,end:int,value:string,l:string,r:string,l2:string,r2:string>>"
_PAIRS = "array<struct<start:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chunks(array: Column) -> Column:
    """A non-empty array in runs of CHUNK elements."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(array) - 1) / CHUNK).cast("int")), lambda k: F.slice(array, k * CHUNK + 1, F.lit(CHUNK)))


def _starts(gaps: Column, found: Column) -> Column:
    """Where matches start: running sums of the lengths of the text between them and of the matches, run by run."""
    none = F.array().cast("array<int>")
    step = lambda acc, s: F.struct((acc["at"] + s["gap"] + s["size"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + s["gap"])).alias("out"))
    sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("size")))

    def walk(runs: Column) -> Column:
        sums = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda a, s: a + s["gap"] + s["size"]))
        first = F.aggregate(
            sums,
            F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, s: F.struct((acc["at"] + s).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )
        return F.flatten(F.zip_with(runs, first, lambda run, at: F.aggregate(run, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])))

    return _let(sizes, lambda items: _let(_chunks(items), walk))


def _beside(gap: Column, expression: str) -> Column:
    """Words of a gap, in lower case and parted by one blank; empty where the expression finds none."""
    return F.regexp_replace(F.lower(F.regexp_extract(gap, expression, 1)), r"\s+", " ")


def add_matches(df: DataFrame, wanted: dict[str, tuple[str, Column, Callable[[Column], Column]]]) -> DataFrame:
    """Add, for each name, the valid matches of an expression in ``text``, in order, where the condition holds.

    A match is (start, end, value, l, r, l2, r2): ends are exclusive and in code points; l and r are the whole word
    next to it across white space, l2 and r2 the two words next to it. Words are sought as far as the next match of the same
    expression; a match that touches a word, or has none on a side, has empty texts there.
    """
    parts = df.select("*", *[F.when(c, F.regexp_extract_all("text", F.lit(x), F.lit(0))).alias(f"_found_{k}") for k, (x, c, _) in wanted.items()])
    parts = parts.select("*", *[F.when(F.size(f"_found_{k}") > 0, F.split("text", x, -1)).alias(f"_gaps_{k}") for k, (x, _, _) in wanted.items()])

    def spans(k: str, good: Callable[[Column], Column]) -> Column:
        found, gaps = F.col(f"_found_{k}"), F.col(f"_gaps_{k}")
        around = F.transform(
            found,
            lambda v, i: F.struct(
                v.alias("value"), F.get(gaps, i).alias("before"), F.get(gaps, i + 1).alias("after"), (i == 0).alias("first"), (i == F.size(found) - 1).alias("last")
            ),
        )
        whole = F.filter(F.zip_with(_starts(gaps, found), around, lambda s, m: F.struct(s.alias("start"), m.alias("m"))), lambda x: good(x["m"]["value"]))

        def with_words(x: Column) -> Column:
            m = x["m"]
            left = lambda n: F.when(m["first"], _beside(m["before"], rf"(?:^|\s)({n})\s++$")).otherwise(_beside(m["before"], rf"\s({n})\s++$"))
            right = lambda n: F.when(m["last"], _beside(m["after"], rf"^\s++({n})(?:\s|$)")).otherwise(_beside(m["after"], rf"^\s++({n})\s"))
            one, two = r"\S++", r"\S++\s++\S++"
            return F.struct(
                x["start"].alias("start"), (x["start"] + F.length(m["value"])).alias("end"), m["value"].alias("value"),
                left(one).alias("l"), right(one).alias("r"), left(two).alias("l2"), right(two).alias("r2"),
            )

        return F.transform(whole, with_words)

    named = [F.coalesce(F.when(F.col(f"_gaps_{k}").isNotNull(), spans(k, good)), F.array().cast(_INSTANCE)).alias(k) for k, (_, _, good) in wanted.items()]
    return parts.select(*df.columns, *named)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""

    def weigh(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)

    each = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(F.filter(each, lambda n: n.isNotNull()), F.lit(0), lambda a, n: a + n) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """Add one array of valid base spans a kind to rows with a non-null ``text``."""
    hints = {k: F.contains("text", F.lit(h)) if k == "email" else F.col("text").rlike(h) for k, h in BASE_HINT.items()}
    return add_matches(docs.drop(*KINDS), {k: (BASE[k], hints[k], lambda v, k=k: valid(k, v)) for k in KINDS})


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda m: F.concat_ws(":", F.lit(kind), m["start"].cast("string"), m["end"].cast("string")))


def _terms(text: Column) -> Column:
    """The words of a text between white space, in lower case, and each two neighbours parted by one blank."""

    def both(words: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
        return F.when(F.size(words) > 1, F.concat(words, pairs)).otherwise(words)

    return _let(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), both)


def _clear(base: Column) -> Callable[[Column], Column]:
    """Whether a match overlaps none of the base spans, which ascend: by binary search for the last that starts before its end."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(31))])

    def clear(m: Column) -> Column:
        before = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(F.get(base, lo + step - 1)["start"] < m["end"], lo + step).otherwise(lo))
        return F.when(F.size(base) == 0, True).otherwise(_let(before, lambda n: F.when(n == 0, True).otherwise(F.get(base, n - 1)["end"] <= m["start"])))

    return clear


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, an array of base spans a kind, an array loose_<kind> of other candidates) of each whole text; written out."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    shaped = add_matches(base_spans(rows), {f"loose_{k}": (LOOSE[k], F.col("text").rlike(LOOSE_HINT[k]), lambda v: F.lit(True)) for k in KINDS})
    fresh = [F.filter(f"loose_{k}", _clear(F.col(k))).alias(f"loose_{k}") for k in KINDS]
    return settle(shaped.select("doc_id", "text_hash", *KINDS, *fresh))


def discover(found: DataFrame, docs: DataFrame, support: int = SUPPORT, share: float = SHARE, trust: float = TRUST) -> DataFrame:
    """Unseen identifiers by bootstrapped contexts: doc_id, text_hash, kind, start, end.

    ``found`` has the matches of ``docs``. A pattern is a side and the word, or the two words, next to an instance
    there, for one kind. Its confidence is the share of all places of these words in the corpus that
    are at accepted instances of the kind; patterns with ``support`` distinct accepted values and
    a confidence of ``share`` pass. An instance is accepted if 1 - (1 - left) (1 - right) reaches ``trust``, left and
    right being the best confidences on its sides, over all its occurrences; base spans always are. The accepted
    ones induce further patterns, until no instance is new: both only grow, so this ends. Common words
    have confidences near 0, so clean text gains nothing.
    """
    tagged = lambda kind, spans, seed: F.transform(spans, lambda m: F.struct(F.lit(kind).alias("kind"), F.lit(seed).alias("seed"), m.alias("m")))
    every = F.concat(*[tagged(k, F.col(k), True) for k in KINDS], *[tagged(k, F.col(f"loose_{k}"), False) for k in KINDS])
    instances = settle(found.select("doc_id", "text_hash", F.explode(every).alias("x")).select("doc_id", "text_hash", "x.kind", "x.seed", "x.m.*"))
    terms = F.array(*[F.struct(F.lit(c[0]).alias("side"), F.col(c).alias("term")) for c in ("l", "r", "l2", "r2")])
    edges = instances.select("kind", "value", "seed", F.explode(terms).alias("p")).select("kind", "value", "seed", "p.*").where("term <> ''")
    pattern = ["kind", "side", "term"]
    edges = edges.groupBy("kind", "value", "seed", "side", "term").agg(F.count("*").alias("n"))
    useful = edges.groupBy(*pattern).agg(F.count_distinct("value").alias("values")).where(F.col("values") >= support).select(*pattern)
    edges = settle(edges.join(useful, pattern, "left_semi"))  # a pattern of too few values never passes
    cues = settle(edges.select("term").distinct())
    places = docs.select(F.explode(_terms(text_or_empty())).alias("term")).join(broadcast_if_small(cues), "term", "left_semi")
    corpus = settle(places.groupBy("term").agg(F.count("*").alias("all")))
    seeds = edges.where("seed").select("kind", "value").distinct()
    accepted, known = settle(seeds), -1
    while (now := accepted.count()) != known:
        known = now
        score = (
            edges.join(accepted, ["kind", "value"], "left_semi")
            .groupBy(*pattern)
            .agg(F.count_distinct("value").alias("values"), F.sum("n").alias("at"))
            .where(F.col("values") >= support)
            .join(corpus, "term")
            .withColumn("conf", F.least(F.col("at") / (F.col("all") + 1), F.lit(0.999)))
            .where(F.col("conf") >= share)
            .select(*pattern, "conf")
        )
        best = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("conf"))), F.lit(0.0))
        trusted = edges.where("not seed").join(score, pattern).groupBy("kind", "value").agg((1 - (1 - best("l")) * (1 - best("r"))).alias("trust"))
        accepted = settle(seeds.unionByName(trusted.where(F.col("trust") >= trust).select("kind", "value")).distinct())
    return instances.where("not seed").join(accepted, ["kind", "value"], "left_semi").select("doc_id", "text_hash", "kind", "start", "end").distinct()


def _same_text() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("text_hash") == F.col("x_hash"))


def _with_discovered(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of matches with an array ``more`` of the spans discovered in the text: at most as many as the text has."""
    extra = discover(found, docs).groupBy(F.col("doc_id").alias("x_id"), F.col("text_hash").alias("x_hash"))
    return found.join(extra.agg(F.collect_list(F.struct("kind", "start", "end")).alias("more")), _same_text(), "left").drop("x_id", "x_hash")


def _more(kind: str) -> Column:
    own = F.transform(F.filter("more", lambda m: m["kind"] == kind), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    return F.coalesce(own, F.array().cast(_PAIRS))


def _places(kind: str) -> Column:
    return F.transform(kind, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))


def _digest() -> list[Column]:
    """The counts of valid base spans by kind, and the hash of the list of them."""
    base = F.concat(*[_listed(k, F.col(k)) for k in KINDS])
    return [*[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256")]


def detect(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text.

    Result: doc_id, n_email, n_ip, n_card, n_phone (valid base spans), base_sha256 (of the base spans as
    kind:start:end, by kind, then start, comma-joined), spans (base and discovered ones, likewise).
    Matches are leftmost and do not overlap within a kind; positions are code points. A null or
    empty text has no spans. Repeated rows stay, each with its own spans; rows that share an id but
    not a text are told apart by a hash of the text. Only doc_id and text are read. An empty table gives no rows.
    """
    every = F.concat(*[_listed(k, F.array_sort(F.concat(_places(k), _more(k)))) for k in KINDS])
    return _with_discovered(matches(docs), docs).select("doc_id", *_digest(), F.array_join(every, ",").alias("spans"))


def base_digest(docs: DataFrame) -> DataFrame:
    """The base columns of detect() alone: doc_id, the counts, base_sha256, and spans (of the base)."""
    text = text_or_empty()
    found = base_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")))
    return found.select("doc_id", *_digest(), F.array_join(F.concat(*[_listed(k, F.col(k)) for k in KINDS]), ",").alias("spans"))


def _hidden(spans: Column) -> Column:
    """``text`` with its spans (start, last: the end's negative, kind; ascending) replaced by their kinds in brackets."""
    piece = "array<struct<from:int,to:int,kind:string>>"

    def step(acc: Column, m: Column) -> Column:
        new = F.struct(acc["at"].alias("from"), m["start"].alias("to"), m["kind"].alias("kind"))
        kept = F.when(m["start"] >= acc["at"], F.concat(acc["out"], F.array(new))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], -m["last"]).alias("at"), kept.alias("out"))

    def walked(acc: Column, run: Column) -> Column:
        inner = F.aggregate(run, F.struct(acc["at"].alias("at"), F.array().cast(piece).alias("out")), step)
        return _let(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["runs"], F.array(x["out"])).alias("runs")))

    state = F.aggregate(_chunks(spans), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{piece}>").alias("runs")), walked)

    def shown(run: Column) -> Column:
        lo, hi = F.get(run, F.lit(0))["from"], F.element_at(run, -1)["to"]
        part = F.substr(F.col("text"), lo + 1, hi - lo)
        cut = lambda t: F.transform(run, lambda p: F.concat(F.substr(t, p["from"] - lo + 1, p["to"] - p["from"]), F.lit("["), p["kind"], F.lit("]")))
        return _let(part, lambda t: F.array_join(cut(t), ""))

    return _let(
        state,
        lambda s: F.concat(
            F.array_join(F.transform(F.filter(s["runs"], lambda run: F.size(run) > 0), shown), ""), F.substr(F.col("text"), s["at"] + 1, F.length("text"))
        ),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with each span of their text replaced by its kind in brackets.

    All columns stay, and all rows; a text without spans is unchanged, null included. Where spans of
    several kinds overlap, the one that starts first (then the longest, then by kind) is replaced and
    the rest of the others goes with it.
    """
    columns = docs.columns
    found = _with_discovered(matches(docs), docs)
    tag = lambda k, spans: F.transform(spans, lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("last"), F.lit(k).alias("kind")))
    every = F.array_sort(F.concat(*[tag(k, F.col(k)) for k in KINDS], *[tag(k, _more(k)) for k in KINDS]))
    held = found.select(F.col("doc_id").alias("x_id"), F.col("text_hash").alias("x_hash"), every.alias("_spans")).where(F.size("_spans") > 0)
    held = held.dropDuplicates(["x_id", "x_hash"])
    rows = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    joined = rows.withColumn("text_hash", F.xxhash64("text")).join(held, _same_text(), "left")
    clean = F.when(F.col("_spans").isNotNull(), _hidden(F.col("_spans"))).otherwise(F.col("_row")["text"])
    return joined.select(*[clean.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in columns])
