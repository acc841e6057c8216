"""Personal data and credentials: high-recall spans, boosted trees, thresholds.

Fixed patterns propose emails, addresses, card and phone numbers; a span that
its kind's own rule accepts always counts. Wider generators propose further,
overlapping spans: values after a credential word, long tokens that mix digits
with letters, addresses spelt with "at" and "dot", IPv6, phone numbers without
"+"; and matches of the fixed patterns that fail their rule are proposed again.
Boosted trees, one forest a kind, score these by format and context. They are
fitted here to weak labels that rules give to clear cases (a credential word
before a mixed token; a number, a piece of an accepted span, a word with a
year; for numbers and addresses, the accepted spans, and what has a form that
only one sort has). Clear cases of the four fixed kinds need no score, and the score from which a span is taken is set on rows the fit did not
see. Every clear case of the table is in the fit or in the threshold. Where a table has fewer than two clear
cases of a sort, the trees do not run and its clear credentials count.

Built-in functions and the DataFrame-based ML library only. NULL and empty
texts have no spans. Every row is judged by itself, so repeated rows repeat
their result. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.session import materialize

# Fixed patterns. Against the contract's, runs are possessive and a match may
# not begin inside a run (only where the last match ended), which finds the
# same matches without trying every start of a long run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORDS = r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|credential)"
GENERATORS = {
    "keyed": rf"(?i)(?<={WORDS}\s{{0,2}}[=:]\s{{0,2}}[\x22']?)[^\s\x22'=:]{{6,}}",
    "mixed": r"(?<![A-Za-z0-9])(?=[A-Za-z]{0,64}[0-9])[A-Za-z0-9]{8,}+",
}
AT = r"(?:\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\sat\s|\s?@\s?)"
DOT = r"(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|\.)"
GENERATORS |= {
    "spelt": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)+",
    "ipv6": r"(?i)(?<![0-9a-z:.])(?=[0-9a-f]{0,4}:[0-9a-f]{0,4}:)(?:[0-9a-f]{1,4}|:)(?::[0-9a-f]{0,4}){1,8}+(?:(?<=:[0-9]{1,3})(?:\.[0-9]{1,3}){3})?(?![0-9a-z:])",
    "dialled": r"(?<![A-Za-z0-9])(?:\+?1[\x20.-]?)?\(?(?<![0-9])[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9+.-])\(?[0-9]{2,5}\)?(?:[\x20.-]\(?[0-9]{2,6}\)?){1,4}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9+.-])[0-9]{7,15}(?![A-Za-z0-9])",
}
#: Kind of a proposal, and the words that announce one.
KIND_OF = {"keyed": "secret", "mixed": "secret", "spelt": "email", "ipv6": "ip", "dialled": "phone"} | {k: k for k in PATTERNS}
ANNOUNCED = {
    "email": "e-?mail|mail|mailto|contact|write to",
    "ip": "ip|ips|ipv4|ipv6|address|addr|host|server|client|peer|gateway|dns",
    "card": "card|credit|debit|visa|mastercard|maestro|amex|pan",
    "phone": "phone|telephone|tel|call|mobile|cell|fax|dial|whatsapp|ph",
}
#: What a text must hold for a pattern to be tried.
MAY = {"email": "@", "keyed": "[=:]", "spelt": r"(?i)@|\sat\s|[\[({<]\s?at\s?[\])}>]", "ipv6": ":[0-9a-fA-F]{0,4}:"}
KINDS = ["email", "ip", "card", "phone", "secret"]
BEFORE, AFTER = 24, 2

#: Up to so many clear cases of a label are dealt to the folds by counting, more by hash. All are
#: fitted; where there are more, a label's weight is as if either had half of so many.
MAX_LABELLED = 20_000
#: Clear cases to a task of the fit.
FIT_ROWS = 100_000
#: Share of right spans, among the clear cases at or above the threshold.
PRECISION = 0.95


def _found(text: Column, name: str, pattern: str) -> Column:
    """Array of (gen, nth, value, gap length, before, after) of all matches.
    A split has what lies between the matches, hence where they are."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    may = text.rlike(MAY.get(name, "[0-9]"))
    # `gaps` and `values` are built once: they are the input of the outer call.
    both = F.when(may, F.struct(values.alias("v"), gaps.alias("g")))
    return F.transform(F.array(both), lambda b: F.transform(
        b["v"],
        lambda v, i: F.struct(
            F.lit(name).alias("gen"),
            i.alias("nth"),
            v.alias("value"),
            F.char_length(F.get(b["g"], i)).alias("gap"),
            F.right(F.get(b["g"], i), F.lit(BEFORE)).alias("before"),
            F.left(F.get(b["g"], i + 1), F.lit(AFTER)).alias("after"),
        ),
    ))[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _accepted(gen: Column, value: Column) -> Column:
    """Whether a match of a fixed pattern passes its kind's rule."""
    digits, n = _digits(value), F.char_length(_digits(value))
    part = lambda p: F.char_length(F.ltrim(p, F.lit("0"))) <= 3
    byte = lambda p: part(p) & (F.right(p, F.lit(3)).cast("int") <= 255)
    return (
        F.when(gen == "email", True)
        .when(gen == "ip", F.forall(F.split(value, r"\."), byte))
        .when(gen == "card", F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
        .when(gen == "phone", n.between(10, 15))
        .otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """All proposed spans, and one row without a span (gen NULL) for a
    document that has none: rid, doc_id, gen, start, end, value, before, after, accepted."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), text.alias("text"))
    every = F.concat(*[F.coalesce(_found(F.col("text"), k, p), F.array()) for k, p in (PATTERNS | GENERATORS).items()])
    spans = rows.select("doc_id", "rid", F.explode_outer(every).alias("m")).select("doc_id", "rid", "m.*")
    own = Window.partitionBy("rid", "gen").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    n = F.char_length("value")
    end = F.sum(F.col("gap") + n).over(own)
    spans = spans.select("*", end.alias("end"), (end - n).alias("start"), _accepted(F.col("gen"), F.col("value")).alias("accepted"))
    return spans.drop("gap", "nth")


def _share(value: Column, chars: str) -> Column:
    return F.char_length(F.regexp_replace(value, f"[^{chars}]", "")) / F.char_length(value)


def _announced() -> Column:
    """Whether a word of the span's kind stands shortly before it."""
    hit = F.lit(False)
    for kind, words in ANNOUNCED.items():
        near = F.col("before").rlike(rf"(?i)(?<![A-Za-z])(?:{words})(?![A-Za-z])[^0-9\n]{{0,12}}$")
        hit = F.when(F.col("kind") == kind, near).otherwise(hit)
    return hit


def features(spans: DataFrame) -> DataFrame:
    """Format and context of the spans of the wider generators."""
    v, before = F.col("value"), F.col("before")
    turns = F.size(F.split(v, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"))
    return (
        spans.withColumn("f_length", F.char_length(v).cast("double"))
        .withColumn("f_digits", _share(v, "0-9"))
        .withColumn("f_upper", _share(v, "A-Z"))
        .withColumn("f_hex", _share(v, "0-9a-f"))
        .withColumn("f_turns", turns / F.char_length(v))
        .withColumn("f_distinct", F.size(F.array_distinct(F.split(v, ""))) / F.char_length(v))
        .withColumn("f_assigned", before.rlike(r"[=:]\s{0,2}[\x22']?$").cast("double"))
        .withColumn("f_groups", F.size(F.split(v, "[^0-9A-Za-z]++")).cast("double"))
        .withColumn("f_number", F.char_length(_digits(v)).cast("double"))
        .withColumn("f_luhn", F.when(F.col("gen") == "card", _luhn(_digits(v))).otherwise(False).cast("double"))
        .withColumn("f_announced", _announced().cast("double"))
        .withColumn("f_in_word", F.concat(F.right(before, F.lit(1)), "after").rlike(r"[@._+-]").cast("double"))
    )


NUMBER_FEATURES = ["f_length", "f_digits", "f_groups", "f_number", "f_luhn", "f_announced", "f_assigned", "f_in_word"]
FEATURES = ["f_length", "f_digits", "f_upper", "f_hex", "f_turns", "f_distinct", "f_assigned", "f_in_word"]


def _weak_label(spans: DataFrame) -> DataFrame:
    """label 1 (credential), 0 (not) or NULL (not clear)."""
    v = F.col("value")
    keyed = F.col("before").rlike(rf"(?i){WORDS}\s{{0,2}}[=:]\s{{0,2}}[\x22']?$")
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.char_length(v) >= 12)
    number = v.rlike("^[0-9]+$")
    word = v.rlike(r"^[A-Za-z]+[0-9]{1,4}$")
    plain = F.col("inside") | number | word
    secret = F.when(keyed & plain, None).when(plain, 0.0).when(keyed & mixed, 1.0)
    return spans.withColumn("label", F.when(F.col("kind") == "secret", secret).otherwise(_clear_number()))


def _clear_number() -> Column:
    """The label of a span of the four fixed kinds."""
    v, gen, told, n = F.col("value"), F.col("gen"), _announced(), F.char_length(_digits(F.col("value")))
    # Hextets: eight, or some left out once; clock times and hardware addresses have other forms.
    groups, gaps = F.size(F.filter(F.split(v, ":"), lambda g: g != "")), F.size(F.split(v, "::")) - 1
    hextets = F.when(v.contains("."), groups + 1).otherwise(groups)
    loose = v.rlike("^:[^:]") | v.rlike("[^:]:$") | (gaps > 1) | v.contains(":::")
    six = ~loose & (((gaps == 0) & (hextets == 8)) | ((gaps == 1) & (hextets <= 7) & (groups >= 1)))
    ipv6 = F.when(six & ((gaps == 0) | (v.rlike("[0-9]") & ((groups > 2) | told | v.rlike("^(?i:fe80|f[cd]..|2...)?::?")))), 1.0)
    ipv6 = ipv6.when(~six, 0.0)
    bracket = r"[\[({<]\s?(?:at|@|dot|\.)\s?[\])}>]"
    spelt = F.when(v.rlike(rf"(?i){bracket}") & v.rlike("(?i)[a-z]{2,}$"), 1.0)
    spelt = spelt.when(v.rlike(r"(?i)\sat\s.*\sdot\s(?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|us)$"), 1.0)
    spelt = spelt.when(~v.rlike("(?i)[a-z]{2,}$") | (~told & ~v.rlike(r"(?i)@|\sdot\s")), 0.0)
    date = v.rlike(r"^(?:(?:19|20)[0-9]{2}[ .-][0-9]{2}[ .-][0-9]{2}|[0-9]{2}[ .-][0-9]{2}[ .-](?:19|20)[0-9]{2})$")
    american = v.rlike(r"^(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}$")
    listed = v.rlike("^[1-9][0-9]*(?: [0-9]+)*$") | v.rlike("^[0-9]+$") | v.rlike(r"^[0-9]+(?:\.[0-9]+)+$")
    dialled = F.when(date | ~n.between(7, 15), 0.0).when(american | told, 1.0).when(listed, 0.0)
    card = F.when(F.col("accepted"), 1.0).when(told, F.when((n < 14) & _luhn(_digits(v)), 1.0)).when(~_luhn(_digits(v)), 0.0)
    return (
        F.when(gen == "spelt", spelt)
        .when(gen == "ipv6", ipv6)
        .when(gen == "card", card)
        .when(F.col("accepted"), 1.0)
        .when(gen == "dialled", dialled)
        .when(gen == "phone", F.when(~n.between(7, 15), 0.0))
        .when((gen == "ip") & ~told, 0.0)
    )

def _score(spans: DataFrame, kind: str) -> DataFrame:
    """``spans`` of ``kind`` that reach the calibrated threshold, scored by
    boosted trees; and the clear ones, if the kind is not the credentials."""
    cols = spans.columns
    names = FEATURES if kind == "secret" else NUMBER_FEATURES
    ready = VectorAssembler(inputCols=names, outputCol="x").transform(features(_weak_label(spans.where(F.col("kind") == kind))))
    if kind != "secret":  # what lies in an accepted span says nothing of its kind, but for that span
        ready = ready.where(~F.col("inside") | F.col("accepted"))
    clear = ready.where(F.col("label").isNotNull())
    found = {r["label"]: r["n"] for r in clear.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if found and min(found.get(y, 0) for y in (0.0, 1.0)) < 2:  # nothing to learn from: the clear credentials stand
        return ready.where(F.col("label") == 1.0).select(*cols)
    if not found:
        return spans.where(F.lit(False))
    # All clear cases: three of four of a label are fitted on, the fourth calibrates.
    rows = clear.select("x", "label", F.xxhash64("doc_id", "start", "value").alias("h"))
    rows = materialize(rows, "clear-spans")
    few = F.col("label").isin([y for y in (0.0, 1.0) if found[y] <= MAX_LABELLED])
    # Counted where a label is rare, so that two rows of it are in both folds.
    nth = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    dealt = rows.where(few).withColumn("nth", nth).unionByName(rows.where(~few).withColumn("nth", F.pmod("h", F.lit(4)).cast("int")))
    dealt = materialize(dealt, "clear-folds")
    fold = F.col("nth") % 4 == 1
    most = {y: min(found[y], max(MAX_LABELLED // 2, MAX_LABELLED - found[1.0 - y])) for y in (0.0, 1.0)}
    weight = F.when(F.col("label") == 1.0, most[1.0] / found[1.0]).otherwise(most[0.0] / found[0.0])
    # As many tasks as the rows need; the fit goes over them many times.
    fit = dealt.where(~fold).withColumn("w", weight).coalesce(2 + sum(found.values()) // FIT_ROWS)
    trees = GBTClassifier(featuresCol="x", labelCol="label", weightCol="w", maxDepth=3, maxIter=8, maxBins=32, seed=7, cacheNodeIds=False)
    model = trees.fit(fit)
    p = vector_to_array("probability")[1]
    graded = model.transform(dealt.where(fold)).select(F.floor(p * 100).cast("int").alias("bin"), "label")
    # 101 rows at most.
    bins = graded.groupBy("bin").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")).collect()
    threshold, yes, n = 1.01, 0.0, 0.0
    for b in sorted(bins, key=lambda r: -r["bin"]):
        yes, n = yes + b["yes"], n + b["n"]
        if yes < PRECISION * n:
            break
        threshold = b["bin"] / 100
    taken = p >= threshold
    if kind != "secret":  # what is clear needs no score
        taken = F.coalesce(F.col("label") == 1.0, taken)
    return model.transform(ready).where(taken).select(*cols)


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, rid and ``spans``, an array of (start, kind
    number, end, base) in order. ``base`` spans come from the fixed patterns;
    the others are proposals that the trees or a clear form chose, without those that lie
    wholly in a base span or in a longer chosen one. One that contains a base
    span or reaches beyond it stays beside it."""
    spans = materialize(candidates(docs), "pii-candidates")
    base = spans.where(F.col("accepted") & F.col("gen").isin(list(PATTERNS)))
    numbers = F.char_length(_digits(F.col("value")))
    again = F.when(F.col("gen") == "card", numbers.between(12, 19)).otherwise(F.col("gen").isin("ip", "phone"))
    kind_of = F.create_map(*[F.lit(x) for pair in KIND_OF.items() for x in pair])
    wide = spans.where(F.col("gen").isin(list(GENERATORS)) | again).withColumn("kind", F.element_at(kind_of, F.col("gen")))
    # Base spans of a row, to see which proposals lie inside one.
    lists = base.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    over = F.exists("taken", lambda t: (t["start"] <= F.col("start")) & (F.col("end") <= t["end"]))
    wide = wide.join(lists, "rid", "left").withColumn("inside", F.coalesce(over, F.lit(False))).drop("taken")
    wide = materialize(wide, "pii-proposals")
    chosen = reduce(DataFrame.union, [_score(wide, kind) for kind in KINDS]).where(~F.col("inside"))
    # Overlapping proposals: one that lies in others that begin before it goes.
    reach = F.max("end").over(
        Window.partitionBy("rid").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    )
    chosen = chosen.select("rid", "start", "end", "kind").distinct().withColumn("reach", reach)
    chosen = chosen.where(F.col("reach").isNull() | (F.col("end") > F.col("reach")))
    number = lambda by: F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col(by))
    span = lambda kind, is_base: F.struct("start", kind.alias("kind"), "end", F.lit(is_base).alias("base"))
    rows = spans.select("rid", "doc_id", F.lit(None).cast("struct<start:bigint,kind:int,end:bigint,base:boolean>").alias("s"))
    parts = (
        rows.dropDuplicates(["rid"])
        .union(base.select("rid", F.lit(None).cast("long"), span(number("gen"), True)))
        .union(chosen.select("rid", F.lit(None).cast("long"), span(number("kind"), False)))
    )
    return parts.groupBy("rid").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.array_sort(F.collect_list("s")).alias("spans")
    )


def as_string(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets. Spans that
    overlap an earlier one are cut with it."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(s: Column, p: Column) -> Column:
        gap = F.substring(text, (s["at"] + 1).cast("int"), (p["start"] - s["at"]).cast("int"))
        cut = F.struct(F.concat(s["out"], gap, F.lit("["), F.get(kinds, p["kind"]), F.lit("]")).alias("out"), p["end"].alias("at"))
        past = F.struct(s["out"].alias("out"), F.greatest(s["at"], p["end"]).alias("at"))
        return F.when(p["start"] >= s["at"], cut).otherwise(past)

    def rest(s: Column) -> Column:
        return F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text)))

    return F.aggregate(spans, start, step, rest)
