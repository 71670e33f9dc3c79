"""Operator 6: personal data by candidate gradient boosting, with DataFrame functions only.

1. High-recall generators propose spans that may overlap: the four base patterns (also the matches
   that fail their checks) and looser ones. Only lengths, matches and a little context of each
   match leave the scan; a window sum over the gaps gives the positions.
2. Each candidate has its kind and format and context features, all yes or no, as one bit vector.
   Examples are weakly labelled: base kinds by their own checks; looser kinds fail by formats that are
   never given out (check digits, area and group numbers, endings) or by a word before them that says
   otherwise (version, order, price and the like), and pass by check digits, or by a sound format after
   a word that says so. All others carry no label. Spark counts both labels for every vector; those counts
   (exact over all rows; at most 2 ** len(FEATURES) * len(KINDS) rows, as a vector holds one kind) are all
   that the boosting of depth-two trees needs.
3. The trees score all candidates as SQL expressions. The threshold of a kind is the lowest score from
   which on its own examples reach PRECISION; a kind without passing examples is held to the highest
   threshold of any looser kind. Base spans always stay; a looser candidate that reaches its threshold is
   added if it overlaps no base span and no looser span selected before it, from left to right.

Defined cases: null and empty texts have no spans; spans are in code points of the whole text;
repeated rows are read row by row; an empty table gives no row; without passing examples of a looser kind
nothing is added; patterns iterate, so runs of any length are read; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

BASE = ("email", "ip", "card", "phone")
#: Pattern of each generator, and a cheap test of the whole text. A run is only entered at its start or after a match.
GENERATORS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "spelled_email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]++)++", r"[\[(]\x20?(?:at|AT)"),
    "local_phone": (r"(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])", r"[0-9]{3}[\x20.-][0-9]{4}"),
    "national_id": (r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", r"[0-9]-[0-9]{2}-[0-9]"),
    "account": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}"),
}
KINDS = (*BASE, *(k for k in GENERATORS if k not in BASE))
LOOSE = KINDS[len(BASE) :]
#: Words right before a candidate that say what it is, by looser kind, and words that say it is something else.
CUES = {
    "spelled_email": "mail|contact|reach|write|at",
    "local_phone": "phone|tel|telephone|call|fax|mobile|cell|contact",
    "national_id": "ssn|social security|social security number|national id|taxpayer id|tin",
    "account": "iban|account|acct|bank",
}
OTHERWISE = "version|release|build|price|usd|isbn|order|invoice|item|part|sku|model|serial|page|pages|ref|case|ticket|id"
CONTEXT = 24
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
ROUNDS, RATE, L2, PRECISION = 24, 0.3, 1.0, 0.95
FEATURES = (
    "at_sign", "plus", "three_dots", "brackets", "digits_10_15", "digits_14_19", "short", "one_run", "letters",
    "glued_left", "glued_right", "cue", "assigned", "line_start", "sound", "said_so", "said_otherwise",
)


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    back = F.reverse(digits)
    digit = lambda i: F.ascii(F.substr(back, i, F.lit(1))) - 48
    doubled = lambda i: F.when(digit(i) > 4, 2 * digit(i) - 9).otherwise(2 * digit(i))
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 0, doubled(i)).otherwise(digit(i)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether the check digits of an international account number hold."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    code = lambda i: F.ascii(F.substr(turned, i, F.lit(1)))
    step = lambda a, i: F.when(code(i) >= 65, a * 100 + code(i) - 55).otherwise(a * 10 + code(i) - 48) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): a written row of every document, and every candidate with start, end, match and context."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    parts = []
    for kind, (pattern, test) in GENERATORS.items():
        there = F.col("text").contains(test) if test == "@" else F.col("text").rlike(test)
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        gaps = F.transform(
            F.split("text", pattern, -1),
            lambda g: F.struct(F.length(g).alias("size"), F.right(g, F.lit(CONTEXT)).alias("tail"), F.left(g, F.lit(CONTEXT)).alias("head")),
        )
        parts.append(F.when(there, F.struct(F.lit(kind).alias("kind"), found.alias("found"), gaps.alias("gaps"))))
    scan = written(rows.select("row", "doc_id", F.array_compact(F.array(*parts)).alias("parts")), "candidates")
    flat = (
        scan.select("row", F.explode("parts").alias("p"))
        .select("row", "p.kind", F.posexplode(F.arrays_zip(F.col("p.found").alias("match"), F.slice("p.gaps", 1, F.size("p.found")).alias("before"), F.slice("p.gaps", 2, F.size("p.gaps")).alias("after"))).alias("at", "z"))
        .select("row", "kind", "at", "z.match", F.col("z.before.size").alias("gap"), F.col("z.before.tail").alias("left"), F.col("z.after.head").alias("right"))
        .where("match is not null")
    )
    upto = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(upto)
    spans = flat.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("match")).drop("at", "gap")
    return scan.select("row", "doc_id"), spans


def checked(spans: DataFrame) -> DataFrame:
    """Adds ``valid`` (null for the looser kinds), the weak ``label`` and the feature vector ``bits``."""
    digits = F.regexp_replace("match", "[^0-9]", "")
    spans = spans.withColumn("digits", digits).withColumn("n", F.length("digits"))
    kind, n, match, left, right = (F.col(c) for c in ("kind", "n", "match", "left", "right"))
    valid = (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", match.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$"))
        .when(kind == "card", F.when(n.between(14, 19), luhn(F.col("digits"))).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
    )
    sound = (
        F.when(kind == "spelled_email", match.rlike(r"[A-Za-z]{2,}$"))
        .when(kind == "local_phone", match.rlike(r"^\(?[2-9][0-9]{2}\)?\x20?[\x20.-]?[2-9][0-9]{2}[\x20.-]") & ~match.rlike(r"555[\x20.-]01[0-9]{2}$"))
        .when(kind == "national_id", ~match.rlike("^(?:000|666|9)|-00-|-0000$"))
        .when(kind == "account", mod97(match))
    )
    said_so = F.lit(False)
    for k, words in CUES.items():
        said_so = F.when(kind == k, left.rlike(rf"(?i)\b(?:{words})(?:\x20(?:no|number|is|me|us|at|on))*\W{{0,4}}$")).otherwise(said_so)
    said_otherwise = left.rlike(rf"(?i)\b(?:{OTHERWISE})(?:\x20(?:no|number|is))*\W{{0,4}}$") & ~said_so
    label = (
        F.when(kind.isin(*BASE), valid)
        .when(~sound | said_otherwise, F.lit(False))
        .when((kind == "account") | said_so, F.lit(True))
    )
    features = {
        "sound": sound,
        "said_so": said_so,
        "said_otherwise": said_otherwise,
        "at_sign": match.rlike(r"@|\b(?:at|AT)\b"),
        "plus": match.startswith("+"),
        "three_dots": F.length(match) - F.length(F.replace(match, F.lit("."), F.lit(""))) == 3,
        "brackets": match.contains("("),
        "digits_10_15": n.between(10, 15),
        "digits_14_19": n.between(14, 19),
        "short": F.length(match) < 9,
        "one_run": match.rlike("^[0-9]+$"),
        "letters": match.rlike("[A-Za-z]"),
        "glued_left": left.rlike(r"[A-Za-z0-9_/.=-]$"),
        "glued_right": right.rlike(r"^[A-Za-z0-9_/=-]"),
        "cue": left.rlike(r"(?i)(?:mail|phone|tel|call|fax|mobile|contact|card|visa|account|iban|ssn|ip|host|address)\W{0,4}$"),
        "assigned": left.rlike(r"[=:\"']\s*$"),
        "line_start": (left == "") | left.rlike(r"\n$"),
    }
    said = [*(features[f] for f in FEATURES), *(kind == k for k in KINDS)]
    bits = sum((F.coalesce(x, F.lit(False)).cast("int") * (1 << k) for k, x in enumerate(said)), F.lit(0))
    return spans.withColumn("valid", valid).withColumn("label", label).withColumn("bits", bits).drop("digits", "n", "left", "right")


@dataclass
class Tree:
    """Two questions deep: values by (first answer, second answer)."""

    first: int
    second: tuple[int, int]
    values: tuple[float, float, float, float]

    def at(self, bits: int) -> float:
        a = bits >> self.first & 1
        return self.values[2 * a + (bits >> self.second[a] & 1)]

    def column(self, bits: Column) -> Column:
        has = lambda k: bits.bitwiseAND(1 << k) != 0
        no, yes = (F.when(has(self.second[a]), self.values[2 * a + 1]).otherwise(self.values[2 * a]) for a in (0, 1))
        return F.when(has(self.first), yes).otherwise(no)


def cutoff(examples: list[tuple[float, int, int]]) -> float:
    """The lowest score from which on rows (score, passed, failed) reach PRECISION; infinite if none does."""
    passed_all = failed_all = 0
    threshold = math.inf
    order = sorted(examples, key=lambda x: -x[0])
    for i, (score, passed, failed) in enumerate(order):
        passed_all, failed_all = passed_all + passed, failed_all + failed
        last = i + 1 == len(order) or order[i + 1][0] < score
        if last and passed_all and passed_all >= PRECISION * (passed_all + failed_all):
            threshold = score - 1e-9  # sums may differ in their last digit
    return threshold


def thresholds(trees: list[Tree], examples: list[tuple[int, int, int]]) -> dict[str, float]:
    """The threshold of each looser kind, from its own examples or the strictest of the others."""
    own = {}
    for k, kind in enumerate(KINDS):
        if kind in LOOSE:
            bit = 1 << len(FEATURES) + k
            own[kind] = cutoff([(sum(t.at(b) for t in trees), p, f) for b, p, f in examples if b & bit])
    known = [x for x in own.values() if x < math.inf]
    return {kind: x if x < math.inf else max(known, default=math.inf) for kind, x in own.items()}


def boost(examples: list[tuple[int, int, int]]) -> tuple[list[Tree], float]:
    """Trees from rows (bits, passed, failed), by Newton steps on the logistic loss, and the threshold over all rows."""
    score = {bits: 0.0 for bits, _, _ in examples}
    trees: list[Tree] = []
    k = range(len(FEATURES) + len(KINDS))

    def sums(rows: list, feature: int) -> list[list[float]]:
        out = [[0.0, 0.0], [0.0, 0.0]]
        for bits, g, h in rows:
            side = out[bits >> feature & 1]
            side[0] += g
            side[1] += h
        return out

    gain = lambda s: sum(g * g / (h + L2) for g, h in s)
    for _ in range(ROUNDS if examples else 0):
        rows = []
        for bits, passed, failed in examples:
            p = 1 / (1 + math.exp(-score[bits]))
            rows.append((bits, passed - (passed + failed) * p, (passed + failed) * p * (1 - p)))
        best: tuple = (-1.0,)
        for first in k:
            sides = [[r for r in rows if r[0] >> first & 1 == a] for a in (0, 1)]
            seconds = [max(k, key=lambda f, s=side: gain(sums(s, f))) for side in sides]
            parts = [sums(side, f) for side, f in zip(sides, seconds, strict=True)]
            total = gain(parts[0]) + gain(parts[1])
            if total > best[0]:
                best = (total, first, tuple(seconds), tuple(RATE * g / (h + L2) for part in parts for g, h in part))
        tree = Tree(*best[1:])
        trees.append(tree)
        for bits in score:
            score[bits] += tree.at(bits)
    return trees, cutoff([(score[bits], passed, failed) for bits, passed, failed in examples])


def _left_to_right(loose: DataFrame) -> DataFrame:
    """Of overlapping spans the leftmost stays, then the next one clear of it: per run of overlapping spans, in order."""
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    runs = loose.withColumn("opens", (F.coalesce(F.max("end").over(before), F.lit(-1)) <= F.col("start")).cast("int")).withColumn("run", F.sum("opens").over(upto))
    one = F.struct("start", (-F.col("score")).alias("less"), "kind", "end")
    listed = runs.groupBy("row", "run").agg(F.array_sort(F.collect_list(one)).alias("all"))
    first = F.struct(F.lit(-1).cast("long").alias("upto"), F.slice("all", 1, 0).alias("kept"))
    step = lambda a, x: F.when(
        x["start"] >= a["upto"], F.struct(x["end"].alias("upto"), F.concat(a["kept"], F.array(x)).alias("kept"))
    ).otherwise(a)
    kept = listed.select("row", F.explode(F.aggregate("all", first, step)["kept"]).alias("x"))
    return kept.select("row", "x.kind", "x.start", "x.end", F.lit(False).alias("base"), (-F.col("x.less")).alias("score"))


def redactions(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, selected): rows (row, doc_id), and rows (row, kind, start, end, base, score) of every selected span."""
    scan, spans = candidates(docs)
    spans = written(checked(spans), "spans")
    counts = spans.where("label is not null").groupBy("bits").agg(F.count_if("label").alias("passed"), F.count_if(~F.col("label")).alias("failed"))
    examples = [tuple(r) for r in counts.orderBy("bits").collect()]  # at most 2 ** len(FEATURES) * len(KINDS) rows
    trees, _ = boost(examples)
    score = sum((t.column(F.col("bits")) for t in trees[1:]), trees[0].column(F.col("bits"))) if trees else F.lit(0.0)
    base = F.col("kind").isin(*BASE) & F.coalesce("valid", F.lit(False))
    enough = F.lit(False)
    for kind, least in thresholds(trees, examples).items():
        enough = F.when(F.col("kind") == kind, F.col("score") >= F.lit(least)).otherwise(enough)
    able = spans.withColumn("score", score).withColumn("base", base).where(base | enough).select("row", "kind", "start", "end", "base", "score")
    order = ("start", F.col("base").desc(), "kind")
    before = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.col("start").desc(), "base", F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    last_base = F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(before), F.lit(-1))
    next_base = F.coalesce(F.min(F.when(F.col("base"), F.col("start"))).over(after), F.col("end"))
    able = able.withColumn("clear", (last_base <= F.col("start")) & (next_base >= F.col("end")))
    loose = _left_to_right(able.where("not base and clear"))
    return scan, able.where("base").drop("clear").unionByName(loose)


def op6_boosted_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan, selected = redactions(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    order = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    one = F.struct("start", order.alias("order"), F.concat_ws(":", "kind", "start", "end").alias("said"))
    listed = lambda c: F.concat_ws(",", F.transform(F.array_sort(c), lambda x: x["said"]))
    per_row = selected.groupBy("row").agg(
        *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in BASE),
        listed(F.collect_list(F.when(F.col("base"), one))).alias("base_list"),
        listed(F.collect_list(one)).alias("spans"),
    )
    return scan.join(per_row, "row", "left").select(
        "doc_id",
        *(F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce("base_list", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
