"""Secret scan with a random forest against false positives (operator 3), in SQL functions alone.

Candidates are runs of at least ``LEAST`` key characters with a digit or a known prefix, and whole
values of at least ``LEAST_VALUE`` characters after a key word and = or :. Each gets features: its length, character transitions, how much of it dictionary words cover, whether it looks like
a path, what the document's path says, and its neighbouring words. A random forest trained from
labelled findings decides; it is written out as a SQL expression, so scanning stays in the JVM.

The labelled findings are made by ``labelled``: secrets of known forms, and strings that only look
like them. Dictionary words are the most frequent words of all documents, counted over their whole texts.

Defined results: null and empty texts give no rows; repeated rows repeat their findings; places
are (line, column) from 0 in code points; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, LEAST_VALUE = 12, 8
#: How many of the most frequent words of the documents are dictionary words.
DICTIONARY = 150
TREES, DEPTH, LEAF = 15, 6, 4
THRESHOLD = 0.5

_RUN = r"[A-Za-z0-9+/_.-]*[0-9][A-Za-z0-9+/_.-]*={0,2}"
KEY_WORDS = "password|passwd|pwd|secret|token|api|key|auth|bearer|credential|private|access"
PREFIXES = "AKIA|ASIA|ghp_|gho_|sk_live_|sk-|xox[abp]-|AIza|eyJ|glpat-"
#: A run that is not part of a longer one; the look-ahead asks for the length first.
CANDIDATE = rf"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_.-]{{{LEAST},}})(?:{_RUN}|(?:{PREFIXES})[A-Za-z0-9+/_.-]*+={{0,2}})"
#: What stands before a value, at most 37 characters and a quote, so that "before" holds it.
ASSIGN = rf"(?i:(?:{KEY_WORDS})[A-Za-z0-9_-]{{0,16}}[\"']?\s{{0,3}}[:=]{{1,2}}>?\s{{0,3}}|bearer\s{{1,3}})"
#: A whole value: to its closing quote, else to white space or the next "name=" of a list.
VALUE = "(?<=[:=>\\s\"'])(?:" + "|".join([
    rf'(?<={ASSIGN}\")[^\"]{{{LEAST_VALUE},}}+(?=\")',
    rf"(?<={ASSIGN}')[^']{{{LEAST_VALUE},}}+(?=')",
    rf"(?<={ASSIGN}[\"'])[^\s\"']{{{LEAST_VALUE},}}+",
    rf"(?<={ASSIGN})(?![\"':=>])(?:(?![&,;]\s{{0,3}}\w{{1,40}}=)\S){{{LEAST_VALUE},}}+",
]) + ")"
TEST_WORDS = "test|example|sample|mock|fixture|doc|demo"
FEATURES = ["length", "digits", "uppers", "letter_digit", "digit_letter", "lower_upper", "upper_lower", "vowel_pairs", "same_pairs", "hex", "distinct_share", "dictionary", "separators", "path_like", "path_test", "key_before", "assigned", "quoted", "known_prefix", "number_only", "word_after", "other_signs", "lowers", "vowels", "placeholder"]


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, path, line, column, candidate, before, after): candidates with 40 characters of their line on either side."""
    where = F.col(path) if path in docs.columns else F.lit("")
    lines = docs.select("doc_id", F.coalesce(where.cast("string"), F.lit("")).alias("path"), F.posexplode(F.split("text", "\n")).alias("line", "row"))
    keyed = F.col("row").rlike(ASSIGN)
    lines = lines.where(keyed | F.col("row").rlike(rf"[A-Za-z0-9+/_.-]{{{LEAST},}}") & F.col("row").rlike(f"[0-9]|{PREFIXES}")).withColumn("keyed", keyed)
    either = lambda f: F.when(F.col("keyed"), f(f"{VALUE}|{CANDIDATE}")).otherwise(f(CANDIDATE))
    lines = lines.select("*", either(lambda p: F.regexp_extract_all("row", F.lit(p), F.lit(0))).alias("found")).where(F.size("found") > 0)
    # Places: the text between the candidates, as split gives it, plus the candidates before.
    lines = lines.withColumn("gaps", either(lambda p: F.split("row", p, -1)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + F.length(x["gaps"]) + F.length(x["found"])).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(x["gaps"]))).alias("out"))
    places = F.aggregate(F.arrays_zip("gaps", "found"), start, lambda acc, x: F.when(x["found"].isNull(), acc).otherwise(step(acc, x)), lambda acc: acc["out"])
    rows = lines.select("doc_id", "path", F.col("line").cast("long").alias("line"), "row", F.explode(F.arrays_zip(places.alias("column"), F.col("found").alias("candidate"))).alias("x"))
    rows = rows.select("doc_id", "path", "line", "row", F.col("x.column").cast("long").alias("column"), F.col("x.candidate").alias("candidate"))
    quoted = F.expr("substr(row, int(column) + length(candidate) + 1, 1)").isin('"', "'")
    rows = rows.withColumn("candidate", F.when(quoted, F.regexp_replace("candidate", r"[.]+$", "")).otherwise(F.regexp_replace("candidate", r"[.,;:)\]}]+$", "")))
    before = F.expr("substr(row, greatest(int(column) - 40, 0) + 1, int(column) - greatest(int(column) - 40, 0))")
    after = F.expr("substr(row, int(column) + length(candidate) + 1, 40)")
    return rows.select("doc_id", "path", "line", "column", "candidate", before.alias("before"), after.alias("after")).where(F.length("candidate") >= F.when(F.col("before").rlike(rf"{ASSIGN}[\"']?$"), LEAST_VALUE).otherwise(LEAST))


def features(found: DataFrame, dictionary: list[str]) -> DataFrame:
    """The candidates with FEATURES, all doubles."""
    c, n = F.col("candidate"), F.length("candidate")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w))) or "the"
    low = F.lower(F.regexp_extract("before", r"([^\s]*\s+)?([^\s]*)\s*$", 0))
    values = {
        "length": n,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "letter_digit": share("[A-Za-z](?=[0-9])"),
        "digit_letter": share("[0-9](?=[A-Za-z])"),
        "lower_upper": share("[a-z](?=[A-Z])"),
        "upper_lower": share("[A-Z](?=[a-z])"),
        "vowel_pairs": share("[bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ](?=[aeiouAEIOU])"),
        "same_pairs": share(r"(.)(?=\1)"),
        "hex": c.rlike("^[0-9a-f]+$"),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(c), words, "")) / n,
        "separators": share("[/_.+-]"),
        "path_like": c.rlike(r"/[A-Za-z]+/|^[A-Za-z]+\.[A-Za-z]+") | F.col("before").rlike(r"(://|/)\S*$"),
        "path_test": F.lower("path").rlike(TEST_WORDS),
        "key_before": low.rlike(KEY_WORDS),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$"),
        "known_prefix": c.rlike(f"^({PREFIXES})"),
        "number_only": c.rlike("^[0-9.+/_-]+$"),
        "other_signs": share("[^A-Za-z0-9+/_.-]"),
        "lowers": share("[a-z]"),
        "vowels": share("[aeiouAEIOU]"),
        "placeholder": F.lower(c).rlike(r"^[<{$%*(\[]|pass|secret|token|example|change|your|insert|xxxx|required|none|null|environ"),
        "word_after": F.col("after").rlike(r"^[\"']?[\s,.;]*[a-z]+ [a-z]+"),
    }
    return found.select("*", *(values[f].cast("double").alias(f) for f in FEATURES))


def labelled(n: int = 1500, seed: int = 5) -> list[tuple[int, str, str, int]]:
    """(doc_id, text, source, label): one finding per text, 1 for a secret."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    chars = lambda alphabet, k: "".join(rng.choice(list(alphabet), k))
    signs = "!@#$%^*?+-_"
    hexa, upper, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: "".join(pick("th", "er", "on", "an", "re", "es", "ti", "en", "at", "ou", "ing", "le", "de", "ment", "ca", "lo", "ver") for _ in range(rng.integers(1, 4)))
    out = []
    for i in range(n):
        label = int(rng.random() < 0.5)
        key, end = pick("password", "secret", "token", "api_key", "auth", "access_key"), pick(" = \"{}\"", "={}", ": {}", "='{}'", ": \"{}\"")
        if label:
            body = pick(chars(hexa, rng.integers(16, 65)), chars(alnum, rng.integers(16, 45)), chars(alnum[:52], rng.integers(10, 25)), chars(alnum, rng.integers(8, 12)), chars(alnum + signs, rng.integers(8, 21)) + pick(*signs) + chars(alnum, 2))
            s = pick(key + end.format(body), key + end.format(body), key + end.format(body), "AKIA" + chars(pick(upper, upper[:26]), 16), "ghp_" + chars(pick(alnum, alnum[:52]), 36), "sk_live_" + chars(pick(alnum, alnum[:52]), 24), "Bearer " + chars(pick(alnum, alnum[:52]), 40))
        else:
            s = pick(
                chars("0123456789", rng.integers(12, 20)),
                f"{word()}_{word()}_{word()}{rng.integers(1, 99)}",
                f"commit {chars(hexa, 39)}0",
                f"sha256:{chars(hexa, 63)}1",
                f"{chars(hexa, 8)}-{chars(hexa, 4)}-4{chars(hexa, 3)}-a{chars(hexa, 3)}-{chars(hexa, 12)}",
                f"https://{word()}.example.com/{word()}/{word()}/{rng.integers(1000, 99999)}",
                f"{word()}.{rng.integers(10, 99)}.mail{rng.integers(1, 9)}.example.com",
                f"20{rng.integers(10, 30)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}T10.{rng.integers(10, 60)}.00",
                key + end.format(pick("changeme12345", "your_password_1", "xxxxxxxxxxxx1111", "example_token_00", "<insert_key_here_1>", "0000000000000000")),
                key + end.format(pick("changeme", "your_password", "${SECRET_TOKEN}", "<insert-here>", "{{ password }}", "os.environ[API]", "********", "required")),
                key + end.format(word() + word() + word()),
                f"{key}: {word()}{word()}, {word()} {word()}",
                f"sk-{word()}-{word()}{word()}-{word()}",
                f"ASIA{word()}{word()}{word()}".upper(),
                f"v{rng.integers(1, 9)}.{rng.integers(1, 20)}.{rng.integers(1, 20)}-{word()}{word()}",
                f"/usr/lib/{word()}/{word()}{rng.integers(1, 9)}.so",
            )
        text = f"{word()} {word()} {s} {word()} {word()}."
        out.append((i, text, pick("src/app", "src/test", "docs/example", "src0", "src1", "lib"), label))
    return out


def _tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> tuple | float:
    """(feature, threshold, below, above) or the share of ones of a leaf; splits by Gini impurity."""
    share = float(y.mean())
    if depth == 0 or len(y) < 2 * LEAF or share in (0.0, 1.0):
        return round(share, 4)
    best = None
    for f in sorted(rng.choice(x.shape[1], int(np.sqrt(x.shape[1])) + 2, replace=False)):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= LEAF) & (cut <= len(y) - LEAF)]
        if len(cut):
            a, b = ones[cut - 1], ones[-1] - ones[cut - 1]
            impurity = 2 * (a * (1 - a / cut) + b * (1 - b / (len(y) - cut)))
            k = int(impurity.argmin())
            if best is None or impurity[k] < best[0]:
                best = (impurity[k], int(f), round(float((v[cut[k] - 1] + v[cut[k]]) / 2), 6))
    if best is None:
        return round(share, 4)
    below = x[:, best[1]] <= best[2]
    if below.all() or not below.any():
        return round(share, 4)
    return best[1], best[2], _tree(x[below], y[below], rng, depth - 1), _tree(x[~below], y[~below], rng, depth - 1)


def forest(x: np.ndarray, y: np.ndarray, seed: int = 11) -> list:
    """Trees on bootstrap samples with random feature subsets."""
    rng = np.random.default_rng(seed)
    rows = [rng.integers(0, len(y), len(y)) for _ in range(TREES)]
    return [_tree(x[r], y[r], rng, DEPTH) for r in rows]


def _sql(tree: tuple | float) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    f, cut, below, above = tree
    return F.when(F.col(FEATURES[f]) <= cut, _sql(below)).otherwise(_sql(above))


def predict(tree: tuple | float, x: np.ndarray) -> float:
    """What _sql computes, for tests."""
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def fit(docs: DataFrame) -> tuple[list, list[str]]:
    """(forest, dictionary words)."""
    spark = docs.sparkSession
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w")).where(F.length("w").between(3, 12))
    dictionary = [r["w"] for r in words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(DICTIONARY).collect()]
    data = labelled()
    found = features(candidates(spark.createDataFrame([d[:3] for d in data], "doc_id long, text string, source string")), dictionary)
    label = {d[0]: d[3] for d in data}
    rows = sorted(found.select("doc_id", "column", *FEATURES).collect())
    x, y = np.array([list(r[2:]) for r in rows]), np.array([label[r[0]] for r in rows], float)
    return forest(x, y), dictionary


def scan(docs: DataFrame, model: tuple[list, list[str]] | None = None) -> DataFrame:
    """(doc_id, line, column, finding, score, secret) of every candidate."""
    trees, dictionary = model or fit(docs)
    score = sum((_sql(t) for t in trees), F.lit(0.0)) / len(trees)
    found = features(candidates(docs), dictionary)
    return found.select("doc_id", "line", "column", F.col("candidate").alias("finding"), F.round(score, 6).alias("score")).withColumn("secret", F.col("score") >= THRESHOLD)
