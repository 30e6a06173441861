"""Operator 11: personal data by candidate gradient boosting (DataFrame functions only).

High-recall generators (patterns, each linear in the text) propose spans that may overlap; the
base kinds (email, ip, card, phone) are kept by their checks alone. Every other candidate gets
format features (digits, letters, distinct characters, checksums, calendar) and context features
(cue words before it, neighbouring characters), is scored by boosted trees, and is selected where
its calibrated probability reaches its kind's threshold. A selected span that overlaps a base
span goes; of selected spans that overlap one another the likeliest stays.

Training: no table marks personal data, so examples are planted. CONTEXTS documents (a bounded
sample, the least by text hash) give surroundings; each is joined with every template of
EXAMPLES, whose value is filled from a hash. Spans that the generators find on the planted value
of the template's kind are positive, all others negative. HELD_OUT of the contexts are not trained on: isotonic calibration
and the thresholds (the least probability at which a kind's held-out precision reaches PRECISION)
come from them. Fitting sees at most CONTEXTS times the templates; everything else sees all rows.

Scale: one scan of the texts writes slim candidate rows; starts are running sums over a text's
candidates, after one shuffle of these rows; no text is shuffled. The model is a few thousand nodes.

Defined results: null text: empty; texts without a candidate, however long: zeros, the empty
string's hash and empty spans; null and repeated doc_ids: rows of their own; further columns,
whatever their names, are ignored; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, lower_ascii, stored

BASE = ["email", "ip", "card", "phone"]
LEARNED = ["secret", "iban", "ssn", "local_phone", "birth_date", "account"]
KINDS = BASE + LEARNED

CONTEXTS = 200                     # documents whose text surrounds the planted examples
HELD_OUT = 0.3                     # share of them for calibration and thresholds
PRECISION = 0.97
TREES, DEPTH, STEP = 20, 4, 0.2
BEFORE, AFTER = 32, 8              # characters of context

# The contract's base patterns, written without backtracking: possessive, and started only where
# a run of their first characters begins (or where the last match ended).
_LOCAL = r"[A-Za-z0-9._%+-]"
GENERATORS: list[tuple[str, str]] = [
    ("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("secret", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{16,}+"),
    ("secret", r"(?<=[:=][\x20\x22']{0,2})[^\s\x22',;]{6,}+"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("local_phone", r"(?<![0-9+(])(?:\([0-9]{2,4}\)\x20?|0[0-9]{1,4}[\x20/.-]|[0-9]{3}[\x20.-])"
                    r"[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])"),
    ("birth_date", r"(?<![0-9])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9])"),
    ("account", r"(?<![0-9A-Za-z.])[0-9](?:[\x20-]?[0-9]){7,18}+(?![0-9A-Za-z])"),
]

# Cue words (lower case) looked for in the characters before a candidate.
CUES = {
    "secret": "token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|bearer|credential|clave|contrase|passwort|mot de passe",
    "phone": "call|phone|tel|mobile|cell|fax|whatsapp|dial|llam|appel|anruf|rufnummer",
    "ssn": "ssn|social security|tax id|taxpayer|seguro social|sozialversicherung|s.curit. sociale",
    "bank": "iban|account|acct|konto|cuenta|compte|bank|swift|bic|card|karte|tarjeta|carte",
    "birth": "born|birth|dob|geb|nacid|nacimiento|n.e? le|naissance",
    "other": "order|invoice|version|isbn|commit|sha|md5|checksum|hash|part|serial|page|ref|ticket|publish|updat|build|"
             "rev|model|sku|tracking|case|section|bestell|pedido|commande|file|path|http|id ",
}

# Planted examples by kind (the last: no personal data). The value stands in braces; in it # is a
# digit, % a hexadecimal digit, ^ a capital, ~ a letter or digit; {IBAN} has right check digits.
EXAMPLES: dict[str, list[str]] = {
    "secret": [
        'token = "{%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}"', "api_key={~~~~~~~~~~~~~~~~~~~~~~~~}",
        "secret: {~~~~~~~~~~~~~~~~~~~~}", "password: {~~~~~#~~}", "pwd={~~~~#~~~~}",
        "auth token {%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}", "bearer {~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~}",
        "access key {^^^^################}", "passwort: {~~~#~~~~~}", "contraseña: {~~~~##~~}",
        "mot de passe = {~~#~~~~~}", "private_key: {~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~~}",
        "credentials secret={~~~~~~~~~~~~}"],
    "iban": [
        "iban {IBAN}", "bank account {IBAN}", "{IBAN}", "konto {IBAN}"],
    "ssn": [
        "ssn {###-##-####}", "social security number {###-##-####}", "{###-##-####}", "tax id {###-##-####}"],
    "local_phone": [
        "call {(###) ###-####}", "phone {###-###-####}", "tel. {0## ### ####}", "mobile {###.###.####}",
        "{(###) ###-####}", "fax {0###/### ####}", "llame al {### ### ####}", "appelez {0# ### ###}"],
    "birth_date": [
        "born {1#/0#/19##}", "date of birth {0#.1#.19##}", "dob: {19##-0#-1#}", "geboren am {1#.0#.19##}",
        "nacido el {1#/0#/19##}", "née le {0#/0#/19##}"],
    "account": [
        "account {##########}", "bank account no {############}", "konto {#### #### ##}", "cuenta {##########}",
        "acct: {####-####-####}", "card {################}", "carte {#### #### #### ####}"],
    "": [
        "commit {%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}",
        "sha256 checksum {%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}",
        "md5: {%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}", "file hash={%%%%%%%%%%%%%%%%%%%%}",
        "see http:{//~~~~~~.example.org/~~~~~}", "note: {following}", "{internationalization}", "ratio={##.####}",
        "path={/usr/local/share/~~~~}", "build: {#.##.###-rc#}", "{characteristically-speaking}",
        "NOTE: {ABSOLUTELY}", "result: {nothing}", "version={##.##.##}", "{%%%%%%%%%%%%%%%%%%%%%%%%}",
        "serial {^^##^^^^####^^^^####}", "part {^^## ^^^^ #### ^^^^}", "{^^############}", "order {###-##-####}",
        "part no {###-##-####}", "ticket {###-##-####}", "model {###-##-####}", "invoice {###-###-####}",
        "isbn {###-####-###}", "version {###.###.####}", "tracking {### #### ####}", "pages {### ### ###}",
        "published {1#/0#/20##}", "updated {20##-0#-1#}", "{1#/0#/20##}", "{19##-0#-1#}", "on {1#.0#.19##}",
        "build {20##-1#-0#}", "version {##.##.20##}", "{################}", "order {##########}",
        "serial {############}", "{########}", "ref {#########}", "invoice {########}", "{#### #### ####}",
        "case {##########}", "sku {########}"],
}


# ------------------------------------------------------------------ candidates
def _candidate(gen: int, kind: str, pieces: str):
    p = F.col(pieces)
    return lambda v, i: F.struct(
        F.lit(gen).alias("gen"), F.lit(kind).alias("kind"), i.alias("idx"), F.length(p[i]).alias("gap"), v.alias("value"),
        F.lower(F.right(p[i], F.lit(BEFORE))).alias("before"), F.left(p[i + 1], F.lit(AFTER)).alias("after"))


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per candidate (and one for a row without any): the columns of ``df`` but its text,
    and cand: (gen, kind, idx, gap, value, before, after). ``gap``: characters since the last
    candidate of that generator."""
    t, out, arrays = F.col(text), df, []
    for g, (kind, pattern) in enumerate(GENERATORS):
        m, p = f"__m{g}", f"__p{g}"
        out = out.withColumn(m, F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
        out = out.withColumn(p, F.when(F.size(m) > 0, F.split(t, pattern, -1)))
        arrays.append(F.when(F.size(m) > 0, F.transform(m, _candidate(g, kind, p))))
    keep = [c for c in df.columns if c != text]
    every = F.concat(*[F.coalesce(a, F.array().cast("array<struct<gen:int,kind:string,idx:int,gap:int,value:string,before:string,after:string>>"))
                       for a in arrays])
    return out.select(*keep, F.explode_outer(every).alias("cand")).select(*keep, "cand.*")


def placed(cands: DataFrame, row: str = "rid") -> DataFrame:
    """Adds start and end (exclusive) in code points; ``row`` names a text."""
    w = Window.partitionBy(row, "gen").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(w)
    return cands.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("value"))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(d: Column) -> Column:
    def add(acc, i):
        x = F.substring(d, F.length(d) + 1 - i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return acc + F.when(i % 2 == 0, twice).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"


def is_base() -> Column:
    """Whether a candidate (kind, value) is a span of its base kind."""
    d = _digits(F.col("value"))
    n = F.length(d)
    part = r"(?=[0-9])" + _OCTET
    return (F.when(F.col("kind") == "email", True)
            .when(F.col("kind") == "ip", F.col("value").rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
            .when(F.col("kind") == "card", n.between(13, 19) & F.coalesce(F.when(n.between(13, 19), luhn(d)), F.lit(False)))
            .when(F.col("kind") == "phone", n.between(9, 15)).otherwise(False))


# ------------------------------------------------------------------ features
def _mod97(v: Column) -> Column:
    """Check digits of an account number: its characters, the first four last, letters as 10 .. 35."""
    s = F.regexp_replace(v, " ", "")
    s = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, F.lit(1), F.lit(4)))

    def add(acc, c):
        code = F.ascii(c)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)
    return (F.aggregate(F.split(s, ""), F.lit(0), add) == 1).cast("int")


def features() -> dict[str, Column]:
    """Format and context of a candidate (kind, value, before, after)."""
    v, b, a = F.col("value"), F.col("before"), F.col("after")
    cut = F.left(v, F.lit(80))
    n = F.length(cut)

    def share(chars):
        return (n - F.length(F.regexp_replace(cut, chars, ""))) / F.greatest(n, F.lit(1))
    kinds = {f"is_{k}": (F.col("kind") == k).cast("double") for k in LEARNED}
    shape = {"length": F.least(F.length(v), F.lit(200)), "digit_share": share("[0-9]"), "hex_share": share("[0-9a-f]"),
             "upper_share": share("[A-Z]"), "lower_share": share("[a-z]"), "separators": n - F.length(F.regexp_replace(cut, "[ .()/-]", "")),
             "distinct": F.size(F.array_distinct(F.split(cut, ""))), "digit_count": F.length(_digits(cut)),
             "parentheses": v.startswith("("), "slashes": v.startswith("/"),
             "turns": F.length(F.regexp_replace(F.regexp_replace(cut, "[0-9]++", "9"), "[^9]", "")),
             "check_97": F.when(F.col("kind") == "iban", _mod97(v)).otherwise(0),
             "dots": n - F.length(F.replace(cut, F.lit("."), F.lit(""))), "year_19": cut.rlike("(?:^|[./-])19[0-9]{2}")}
    cues = {f"cue_{k}": b.rlike(rf"(?:{words})[^0-9]{{0,14}}$") for k, words in CUES.items()}
    near = {"assigned": b.rlike("[:=][ \"']*$"), "quoted": b.rlike("[\"']$"), "glued_before": b.rlike(r"[\p{L}\p{N}@#/_-]$"),
            "glued_after": a.rlike(r"^[\p{L}\p{N}@/_-]"), "at_start": b == ""}
    return {k: F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in {**kinds, **shape, **cues, **near}.items()}


def featured(cands: DataFrame) -> DataFrame:
    named = features()
    rows = cands.select("*", *[c.alias(f"f_{k}") for k, c in named.items()])
    return VectorAssembler(inputCols=[f"f_{k}" for k in named], outputCol="features").transform(rows) \
        .drop(*[f"f_{k}" for k in named])


# ------------------------------------------------------------------ planted examples and the model
def planted(docs: DataFrame, contexts: int = CONTEXTS) -> DataFrame:
    """(rid, context, held_out, wanted, text, lo, hi): every template in the surroundings of each of at most
    ``contexts`` documents; [lo, hi) is the value's place."""
    h = F.xxhash64("text")
    size = F.length("text")
    some = (docs.select(h.alias("h"), F.substring("text", F.pmod(h, F.greatest(size - 100, F.lit(1))).cast("int") + 1, F.lit(100)).alias("around"))
            .orderBy("h").limit(contexts).withColumn("context", F.monotonically_increasing_id()))
    some = some.withColumn("held_out", F.pmod(F.xxhash64("h", F.lit(3)), F.lit(1000)) < int(HELD_OUT * 1000))
    named = [(kind, t) for kind, texts in EXAMPLES.items() for t in texts]
    templates = F.array(*[F.struct(F.lit(i).alias("nr"), F.lit(wanted).alias("wanted"), F.lit(t.partition("{")[0]).alias("lead"),
                                   F.lit(t.partition("{")[2].partition("}")[0]).alias("value")) for i, (wanted, t) in enumerate(named)])
    e = some.select("*", F.explode(templates).alias("t")).select("h", "around", "context", "held_out", "t.*")

    def pick(chars, i):
        return F.substring(F.lit(chars), (F.pmod(F.xxhash64("h", "nr", i), F.lit(len(chars))) + 1).cast("int"), F.lit(1))

    def filled(template):
        return F.array_join(F.transform(F.split(template, ""), lambda c, i: F.when(c == "#", pick("0123456789", i))
                                        .when(c == "%", pick("0123456789abcdef", i)).when(c == "^", pick("ABCDEFGHJKLMNPRSTUVWXYZ", i))
                                        .when(c == "~", pick("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789", i)).otherwise(c)), "")
    plain = filled(F.when(F.col("value") == "IBAN", F.lit("##################")).otherwise(F.col("value")))
    # right check digits: 98 - (number, DE as 1314, 00) mod 97
    body = F.col("filled")
    rest = F.aggregate(F.split(F.concat(body, F.lit("131400")), ""), F.lit(0), lambda acc, c: (acc * 10 + c.cast("int")) % 97)
    iban = F.concat(F.lit("DE"), F.lpad((F.lit(98) - rest).cast("string"), 2, "0"), body)
    spaced = F.when(F.pmod("h", F.lit(2)) == 0, F.rtrim(F.regexp_replace(iban, "(.{4})", "$1 "))).otherwise(iban)
    e = e.withColumn("filled", plain).withColumn("planted", F.when(F.col("value") == "IBAN", spaced).otherwise(body))
    # half of the leads with a capital, as at the start of a sentence
    lead = F.when(F.pmod(F.xxhash64("h", "nr"), F.lit(2)) == 0, F.col("lead")).otherwise(F.concat(F.upper(F.left("lead", F.lit(1))), F.expr("substring(lead, 2)")))
    left = F.concat(F.left("around", F.lit(60)), F.lit(" "), lead)
    return e.select(F.concat_ws("-", "context", "nr").alias("rid"), "context", "held_out", "wanted",
                    F.concat(left, F.col("planted"), F.lit(" "), F.expr("substring(around, 61)")).alias("text"),
                    F.length(left).alias("lo"), (F.length(left) + F.length("planted")).alias("hi"))


class Model:
    """Boosted trees, their calibration, and (kind, threshold) rows."""

    def __init__(self, trees, isotonic, thresholds: DataFrame):
        self.trees, self.isotonic, self.thresholds = trees, isotonic, thresholds

    def probability(self, feats: DataFrame) -> DataFrame:
        """Adds ``p``, the calibrated probability."""
        margin = self.trees.transform(feats).withColumn("margin", vector_to_array("rawPrediction")[1])
        return self.isotonic.transform(margin.drop("rawPrediction", "probability", "prediction")).withColumnRenamed("prediction", "p")


def fit(docs: DataFrame, contexts: int = CONTEXTS, precision: float = PRECISION) -> Model | None:
    """The model from planted examples; None for a table without rows."""
    rows = placed(candidates(planted(docs, contexts))).where(F.col("kind").isin(*LEARNED))
    # a candidate of the value reaches over it up to a bracket or a blank
    on = (F.col("start") < F.col("hi")) & (F.col("end") > F.col("lo"))
    whole = (F.col("start") >= F.col("lo") - 1) & (F.col("end") <= F.col("hi") + 1) & ((F.col("end") - F.col("start")) * 2 >= F.col("hi") - F.col("lo"))
    rows = rows.where(on).withColumn("label", (whole & (F.col("kind") == F.col("wanted"))).cast("double"))
    # one small file (bounded by ``contexts`` times the templates): sums run in one order, so reruns agree
    rows = stored(featured(rows).select("rid", "kind", "held_out", "label", "features").coalesce(1).sortWithinPartitions("rid", "kind"), "pii-examples")
    train = rows.where(~F.col("held_out"))
    if train.select("label").distinct().count() < 2:
        train = rows
    if rows.select("label").distinct().count() < 2:
        return None
    test = rows.where("held_out")
    if test.select("label").distinct().count() < 2:
        test = rows
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(train)
    margins = trees.transform(test).withColumn("margin", vector_to_array("rawPrediction")[1]).select("kind", "label", "margin")
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label").fit(margins)
    by = isotonic.transform(margins).groupBy("kind", F.col("prediction").alias("p")).agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("kind").orderBy(F.col("p").desc())
    ok = by.select("kind", "p", (F.sum("hits").over(w) / F.sum("n").over(w)).alias("precision")).where(F.col("precision") >= precision)
    return Model(trees, isotonic, stored(ok.groupBy("kind").agg(F.min("p").alias("threshold")), "pii-thresholds"))


# ------------------------------------------------------------------ spans
def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(rid, doc_id, kind, start, end, base, p): all spans; a text without any has one row with a
    null kind. ``rid`` names the input row."""
    docs = id_text(df, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    model = model or fit(docs)
    # written once: the row numbers are fixed, and the texts are not read again
    slim = stored(candidates(docs.withColumn("rid", F.monotonically_increasing_id())), "pii-candidates")
    spans = placed(slim.repartition("rid")).withColumn("base", F.col("kind").isNotNull() & is_base())
    known = spans.where(F.col("base")).select("rid", "doc_id", "kind", "start", "end", "base", F.lit(1.0).alias("p"))
    found = known
    if model is not None:
        scored = model.probability(featured(spans.where(F.col("kind").isin(*LEARNED))))
        chosen = scored.join(F.broadcast(model.thresholds), "kind").where(F.col("p") >= F.col("threshold"))   # a row per kind
        found = known.unionByName(chosen.select("rid", "doc_id", "kind", "start", "end", "base", F.col("p").cast("double")))
    order = Window.partitionBy("rid").orderBy("start", "end", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    taken = F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(before) > F.col("start"), F.lit(False)) | \
        F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(after) < F.col("end"), F.lit(False))
    free = found.withColumn("taken", taken & ~F.col("base")).where(~F.col("taken")).drop("taken")
    # islands of learned spans that overlap: the likeliest, then the longest, then the first stays
    reach = F.max("end").over(Window.partitionBy("rid", "base").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1))
    islands = free.withColumn("new", (F.col("base") | F.coalesce(reach <= F.col("start"), F.lit(True))).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(Window.partitionBy("rid", "base").orderBy("start", "end", "kind")
                                                              .rowsBetween(Window.unboundedPreceding, 0)))
    best = F.row_number().over(Window.partitionBy("rid", "base", "island").orderBy(
        F.col("p").desc(), (F.col("end") - F.col("start")).desc(), "start", "kind"))
    kept = islands.withColumn("best", best).where(F.col("base") | (F.col("best") == 1)).drop("new", "island", "best")
    every = slim.groupBy("rid").agg(F.first("doc_id").alias("doc_id")).select(
        "rid", "doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("start", "long"), ("end", "long"), ("base", "boolean"),
                                                                    ("p", "double"))])
    return kept.unionByName(every)


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The contract's columns, and n_learned."""
    s = scan(docs, model=model)
    nr = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    one = F.struct(nr.alias("nr"), "start", F.concat_ws(":", "kind", "start", "end").alias("span"))
    g = s.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"),
        *[F.count_if(F.col("base") & (F.col("kind") == k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.count_if(~F.col("base")).cast("long").alias("n_learned"),
        F.array_sort(F.collect_list(F.when(F.col("base"), one))).alias("known"),
        F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), one))).alias("every"))
    return g.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(F.array_join("known.span", ","), 256).alias("base_sha256"),
                    F.array_join("every.span", ",").alias("spans"), "n_learned")
