"""Canonical digest lookup of licence texts, in DataFrame functions alone.

A text is brought into canonical form: lower case; copyright lines out; equivalent spellings to one; every
run of other characters than letters and digits to one space; trimmed. Known licence texts (licence_texts)
are normalised by the same expressions and known by SHA-256 digests, and so are documents:

- the whole document, with or without a known title before the text: `license`;
- each of its lines: `line_licenses`, `n_license_lines`;
- each run of paragraphs (parted by blank lines) or lines in it that makes up a whole known text:
  `text_licenses`. A run is looked at where a paragraph is the first one of a known text, so that a
  document of any length is hashed once. Blank units don't count.

Long published texts are known by the digests of their first and of all their paragraphs alone; digests()
gives those of any other text.

Null and empty texts have the digest of the empty string and no licence. Repeated rows are rows each. An
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text
from .licence_digests import DIGESTS
from .licence_texts import NOTICES, TEXTS, TITLES

#: Whole texts by licence identifier: notices first, then the texts with blank lines between paragraphs.
KNOWN = {k: [*NOTICES.get(k, []), *("\n\n".join(t) for t in TEXTS.get(k, []))] for k in {**NOTICES, **TEXTS}}
#: The same with a title in front; these are looked up as whole documents alone.
TITLED = {k: [f"{title}\n\n{text}" for title in titles for text in ("\n\n".join(t) for t in TEXTS[k])] for k, titles in TITLES.items()}

# Spellings that count as equal (from, to), as whole words after lower-casing.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("sub license", "sublicense"),
    ("organisation", "organization"), ("authorise", "authorize"), ("authorised", "authorized"), ("favour", "favor"), ("honour", "honor"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("non commercial", "noncommercial"), ("https", "http"),
]
COPYRIGHT = r"(?m)^[ \t#*/;%-]*((copyright|\(c\)|©)([ \t]*(\(c\)|©|copyright))?[ \t]+([\[<]?(year|yyyy)|[0-9]{4}|by )[^\n]*|all rights reserved\.?[ \t]*)$"


def _spelled(text: Column, several: bool = False) -> Column:
    for a, b in SPELLINGS:
        if several and " " not in a:
            continue
        for _ in range(2):  # twice, as neighbours share the space between them
            text = F.replace(text, F.lit(f" {a} "), F.lit(f" {b} "))
    return text


def plain(text: Column) -> Column:
    """Canonical words with spaces around them; line ends are still there."""
    words = F.regexp_replace(F.regexp_replace(F.lower(text), COPYRIGHT, " "), r"[^\p{L}\p{N}\n]+", " ")
    return _spelled(F.concat(F.lit(" "), F.replace(words, F.lit("\n"), F.lit(" \n ")), F.lit(" ")))


def _units(text: Column, mark: str) -> Column:
    return F.filter(F.transform(F.split(text, mark), lambda x: F.trim(x)), lambda x: x != "")


def lines(plain_text: Column) -> Column:
    return _units(plain_text, "\n")


def paragraphs(plain_text: Column) -> Column:
    joined = F.regexp_replace(F.replace(F.regexp_replace(plain_text, r"\n[ \n]*\n", " \x01 "), F.lit("\n"), F.lit(" ")), " +", " ")
    return _units(_spelled(joined, True), "\x01")


def digests(texts: DataFrame) -> DataFrame:
    """license, k, n, first, whole of texts (license, text): paragraphs, length and digest of the first one, digest of all."""
    parts = texts.select("license", plain(F.col("text")).alias("p")).select("license", paragraphs(F.col("p")).alias("ps")).filter(F.size("ps") > 0)
    return parts.select("license", F.size("ps").alias("k"), F.length(F.get("ps", F.lit(0))).alias("n"), F.sha2(F.get("ps", F.lit(0)), 256).alias("first"), F.sha2(F.array_join("ps", " "), 256).alias("whole"), F.length(F.array_join("ps", " ")).alias("n_whole"))


def known(spark: SparkSession) -> tuple[list[tuple], dict[str, str], dict[str, str]]:
    """(texts as runs: license, k, n, first, whole), licence by digest of a single unit, licence by digest of a document.

    A few hundred entries, fixed in number.
    """
    rows = [(k, t, 0) for k, ts in KNOWN.items() for t in ts] + [(k, t, 1) for k, ts in TITLED.items() for t in ts]
    frame = spark.createDataFrame(rows, "license string, text string, titled int")
    runs, single, whole = set(), {}, {}
    for titled in (0, 1):
        for r in sorted(digests(frame.filter(F.col("titled") == titled)).collect()):
            whole.setdefault(r.whole, r.license)
            if not titled:
                runs |= {(r.license, r.k, r.n, r.first, r.whole), (r.license, 1, r.n_whole, r.whole, r.whole)}
                single.setdefault(r.whole, r.license)
    for license_, k, n, first, all_ in DIGESTS:
        runs.add((license_, k, n, first, all_))
        whole.setdefault(all_, license_)
    return sorted(runs), single, whole


def _map(items: dict) -> Column:
    return F.create_map(*[x if isinstance(x, Column) else F.lit(x) for kv in sorted(items.items()) for x in kv])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, digest, license (of the whole text, or null), line_licenses (of its lines: sorted, distinct), n_license_lines, text_licenses (of runs: sorted, distinct).

    The table of known digests is fixed, so it's a literal map and nothing is shuffled.
    """
    runs, single, whole = known(docs.sparkSession)
    by_first: dict[str, list] = {}
    for license_, k, _, first, all_ in runs:
        by_first.setdefault(first, []).append(F.struct(F.lit(license_).alias("license"), F.lit(k).alias("k"), F.lit(all_).alias("whole")))
    firsts = _map({first: F.array(*xs) for first, xs in by_first.items()})
    sizes = F.array(*[F.lit(n) for n in sorted({r[2] for r in runs})])
    none = F.array().cast("array<string>")

    def found(units: Column) -> Column:
        def at(x, i):
            fits = F.filter(F.element_at(firsts, F.sha2(x, 256)), lambda e: (e["k"] == 1) | (F.sha2(F.array_join(F.slice(units, i + 1, e["k"]), " "), 256) == e["whole"]))
            # a unit as long as no known first one isn't any of them
            return F.when(F.array_contains(sizes, F.length(x)), F.coalesce(F.transform(fits, lambda e: e["license"]), none)).otherwise(none)

        return F.flatten(F.transform(units, at))

    cut = id_text(docs).select("doc_id", plain(F.col("text")).alias("_plain"))
    cut = cut.select("doc_id", lines(F.col("_plain")).alias("_lines"), paragraphs(F.col("_plain")).alias("_paras"))
    lone = F.filter(F.transform("_lines", lambda x: F.when(F.array_contains(sizes, F.length(x)), F.element_at(_map(single), F.sha2(x, 256)))), lambda x: x.isNotNull())
    cut = cut.select("doc_id", F.sha2(F.array_join("_paras", " "), 256).alias("digest"), lone.alias("_lone"), F.concat(found(F.col("_lines")), found(F.col("_paras"))).alias("_runs"))
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return cut.select("doc_id", "digest", F.element_at(_map(whole), F.col("digest")).alias("license"), listed("_lone").alias("line_licenses"), F.size("_lone").cast("long").alias("n_license_lines"), listed("_runs").alias("text_licenses"))
