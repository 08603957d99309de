"""Licences of files by sparse TF-IDF cosine and directory inheritance, in SQL functions (operator 7).

A file's lines, its blocks (between blank lines), its paragraphs (between lines without letters and
digits, as in comments) and its text as a whole are units.  They are compared with templates: notices,
SPDX tags, titles, headers of source files and full texts.  A term weighs by the square root of its count,
times its inverse document frequency among the templates; one that no template has weighs most, so that a
unit is the less like a template the more else it says.  One term alone is no licence, as "mit" is a word of
some languages: a unit has two different ones of a template.

A file named like a licence (LICENSE, COPYING, NOTICE, UNLICENSE) declares its directory's licence by any
unit, others by their first line, block or paragraph or as a whole.  A file without a licence of its own
has that of the nearest directory above it that declares one.

Almost all texts and units drop out in the scan, by bounds that lose nothing: the squared cosine is at most
the share of a template's squared norm that a text holds, and the share of a unit's that is in templates.
Only what is left is joined with the templates' weights.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import let, splittable, stage
from batchgate.llm.licence_texts import TEMPLATES

TERM = r"[\p{L}\p{N}]+(?:\.[0-9]+)*"
BLOCK = r"\n[ \t\r\n]*\n"
PARAGRAPH = r"\n[^\p{L}\p{N}]*\n"
#: Names of files that declare a licence wherever in them it is said.
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[sc]e|copying|notice)[^/]*$"
#: Templates go to every task.
MOST_TEMPLATES = 4096


def terms(text: Column) -> Column:
    """All terms of a text, as often as they occur."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


class Weights:
    """Terms of the templates and their weights."""

    def __init__(self, spark, templates):
        if len(templates) > MOST_TEMPLATES:
            raise ValueError(f"more than {MOST_TEMPLATES} templates")
        rows = spark.createDataFrame([*templates], "license string, notice string")
        held = [(r.license, Counter(r.t)) for r in rows.select("license", terms(F.col("notice")).alias("t")).collect()]
        n = len(held)
        among = Counter(t for _, ts in held for t in ts)
        self.unknown = math.log(1 + n) + 1
        self.weight = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in sorted(among.items())}
        self.parts = [
            {t: math.sqrt(c) * self.weight[t] for t, c in sorted(ts.items())} for _, ts in held
        ]
        norms = [math.sqrt(sum(v * v for v in p.values())) for p in self.parts]
        rows = [
            (t, name, i, self.weight[t], v / norms[i]) for i, (name, _) in enumerate(held) for t, v in self.parts[i].items()
        ]
        self.table = spark.createDataFrame(rows, "term string, license string, template int, w double, share double")

    def reachable(self, held: Column, least: float) -> Column:
        """Whether a unit of these different terms could have a cosine of ``least`` with some template."""
        bags = []
        for part in self.parts:
            whole = sum(v * v for v in part.values())
            shares = F.create_map(*[F.lit(x) for t, v in part.items() for x in (t, v * v / whole)])
            bags.append(F.struct(F.array(*map(F.lit, part)).alias("terms"), shares.alias("shares")))

        def shared(bag: Column) -> Column:
            common = F.array_intersect(bag["terms"], held)
            return let(
                common,
                lambda c: (F.size(c) >= 2)
                & (F.aggregate(c, F.lit(0.0), lambda s, t: s + F.element_at(bag["shares"], t)) >= least * least - 1e-9),
            )

        return F.exists(F.array(*bags), shared) if bags else F.lit(False)

    def square(self, said: Column) -> Column:
        """Sum of the squared weights of known terms, in the order given."""
        by_weight = defaultdict(list)
        for t, w in self.weight.items():
            by_weight[w].append(t)

        def squared(t: Column) -> Column:
            chosen = F.lit(0.0)
            for w, ts in by_weight.items():
                chosen = F.when(t.isin(ts), w * w).otherwise(chosen)
            return chosen

        return F.aggregate(said, F.lit(0.0), lambda s, t: s + squared(t))


def own_licences(
    docs: DataFrame,
    templates=TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = 0.7,
) -> DataFrame:
    """``id, license, cosine, declares`` for each id with a unit whose cosine is at least ``least``.

    The best unit counts; of equal ones the first licence by name.  The cosine is rounded to six digits.
    ``declares`` says whether a first unit is among those found.
    """
    weights = Weights(docs.sparkSession, templates)
    # Cosines are rounded before they are compared.
    bound = least - 1e-6
    known = [*weights.weight]

    def some(text: Column) -> Column:
        held = F.array_distinct(F.filter(terms(text), lambda t: t.isin(known)))
        return let(held, lambda h: (F.size(h) >= 2) & weights.reachable(h, bound))

    def unit(text: Column, at: Column) -> Column:
        return let(
            terms(text),
            lambda t: F.struct(
                (at == 0).alias("first"),
                F.size(t).alias("n"),
                F.array_join(F.array_sort(F.filter(t, lambda x: x.isin(known))), " ").alias("said"),
            ),
        )

    def units(parts: Column) -> Column:
        return F.transform(parts, unit)

    def near(u: Column) -> Column:
        heaviest = max(weights.weight.values(), default=0.0) ** 2
        k = F.size(F.split(u["said"], " "))
        light = k * heaviest >= bound * bound * (k * heaviest + (u["n"] - k) * weights.unknown**2)
        return (u["said"] != "") & light

    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(some(F.col("text")))
    parts = [F.split("text", "\n"), F.split("text", BLOCK), F.split("text", PARAGRAPH), F.array("text")]
    held = F.concat(*[F.filter(units(p), near) for p in parts])
    rows = rows.select("id", F.explode(held).alias("u")).select("id", "u.*").distinct()

    known_terms = F.split("said", " ")
    rows = rows.withColumn("square", weights.square(known_terms))
    size = F.sqrt(F.col("square") + (F.col("n") - F.size(known_terms)) * weights.unknown**2)
    rows = rows.withColumn("size", size).where(F.col("square") >= bound * bound * F.col("size") * F.col("size"))
    unit_key = ["id", "first", "n", "said", "size"]
    word = rows.select(*unit_key, F.explode(known_terms).alias("term")).groupBy(*unit_key, "term").count()
    dot = word.join(F.broadcast(weights.table), "term").groupBy(*unit_key, "license", "template")
    dot = dot.agg(F.sum(F.sqrt("count") * F.col("w") * F.col("share")).alias("dot"), F.count("*").alias("shared"))
    dot = dot.withColumn("cosine", F.round(F.col("dot") / F.col("size"), 6)).where((F.col("cosine") >= least) & (F.col("shared") >= 2))
    best = F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")
    out = dot.groupBy("id").agg(best, F.max("first").alias("declares"))
    return out.select("id", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"), "declares")


def scan(
    files: DataFrame,
    templates=TEMPLATES,
    id_col: str = "doc_id",
    path_col: str = "path",
    text_col: str = "text",
    least: float = 0.7,
) -> DataFrame:
    """``id, path, license, cosine, origin, license_dir`` for each row of ``files``.

    ``origin`` is ``own``, ``inherited`` (``license_dir`` names the directory, the root is empty) or
    ``none``.  Of several declarations in a directory the best counts, then the first licence by name,
    then the first path.  Null and empty texts have no notice of their own and inherit; null paths
    neither declare nor inherit; null ids have none of their own.  Rows of one id share its best notice.
    An empty table gives an empty one; other columns are ignored.
    """
    # Used for the files and for the directories they declare; staged, so that texts are read once.
    own = stage(own_licences(files, templates, id_col, text_col, least), "licences")
    folder = F.regexp_replace("path", "/?[^/]*$", "")
    names = files.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).alias("path"))
    file = splittable(names.withColumn("folder", folder), own, "id", "left")

    declares = F.col("declares") | (F.col("license").isNotNull() & F.col("path").rlike(LICENCE_FILE))
    said = file.where(declares & F.col("folder").isNotNull())
    said = said.groupBy("folder").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license", "path")).alias("b"))
    said = said.select(F.col("folder").alias("above"), F.col("b.license").alias("said"))

    folders = names.select(folder.alias("folder")).where("folder is not null").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    up = folders.select("folder", F.posexplode(above).alias("depth", "above"))
    nearest = splittable(up, said, "above", "inner").groupBy("folder").agg(
        F.max(F.struct("depth", "above", "said")).alias("n")
    )
    file = splittable(file, nearest, "folder", "left")
    mine, given = F.col("license").isNotNull(), F.col("n").isNotNull()
    return file.select(
        "id",
        "path",
        F.coalesce("license", "n.said").alias("license"),
        "cosine",
        F.when(mine, "own").when(given, "inherited").otherwise("none").alias("origin"),
        F.when(~mine & given, F.col("n.above")).alias("license_dir"),
    )
