"""Secret scan with corpus-wide ownership frequency (operator 4), DataFrame functions only.

Every text is scanned for candidate strings. The candidates' hashes are then aggregated over
the whole corpus by distinct repositories and owners: a string that several owners or very many
repositories share is a copied example, one that stays with few looks like a live credential.
Repositories of equal texts count once, so copies of a document do not make its secret an example.

Positions come from splitting the text at the pattern: the pieces between matches and the
matches alternate, so running lengths give code point offsets without a Python function.

Scale: the texts are read once and never shuffled. What moves is one narrow row per candidate
(row number, hash, offsets). Ownership is counted in three partial aggregates, on
(hash, owner, repository), (hash, owner) and (hash), so one string found in a third of all rows
is spread by its repositories and reduced before each shuffle. The verdicts go back by an
equi-join whose two sides Spark can split.

Defined results: null text is scanned as empty; null owners and null repositories each count as
one owner or repository; rows that are equal get equal results, each its own; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.scratch import Scratch, with_row_numbers
from tidewater.tables import table

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Published token formats; found besides the base kinds, and reported when they look live.
VENDOR = (r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{20,}"
          r"|sk_live_[A-Za-z0-9]{24,}|AIza[A-Za-z0-9_-]{35,})")
VENDOR_HINTS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "glpat-", "xoxa-", "xoxb-", "xoxp-", "xoxr-",
                "xoxs-", "sk_live_", "AIza")
JWT = r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "vendor", "jwt")
MIN_ASSIGNED = 6
#: A string of this many distinct owners, or repositories of different texts, counts as a copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 20

_SPAN = "array<struct<start:bigint,place:int,end:bigint,hash:string>>"


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of longs: each round adds the sums that end 1, 2, 4, ... places
    before, so the work is n log n and no array grows."""
    rounds = F.when(F.size(values) > 1, F.sequence(F.lit(0), F.floor(F.log2(F.size(values) - 1)).cast("int")))
    steps = F.transform(F.coalesce(rounds, F.array().cast("array<int>")), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(steps, values, lambda sums, step: F.transform(
        sums, lambda x, i: x + F.when(i >= step, F.get(sums, i - step)).otherwise(F.lit(0).cast("bigint"))))


def _spans(text: Column, place: int, pattern: str, hint: Column, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, place of the kind, end, hash)."""
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # a gap and the match after it: their running length is where the match ends
    lengths = F.zip_with(gaps, matches, lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("bigint"))
    step = F.transform(F.arrays_zip(matches.alias("found"), running_sums(F.slice(lengths, 1, F.size(matches))).alias("end")),
                       lambda p: F.struct((p["end"] - F.length(p["found"])).alias("start"), F.lit(place).alias("place"),
                                          p["end"].alias("end"), p["found"].alias("hash")))
    value = (lambda s: F.regexp_extract(s["hash"], pattern, group)) if group else (lambda s: s["hash"])
    kept = F.filter(step, lambda s: F.length(value(s)) >= least) if least else step
    hashed = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"),
                                                  s["end"].alias("end"), F.sha2(value(s), 256).alias("hash")))
    return F.when(hint, hashed).otherwise(F.array().cast(_SPAN))


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by start and then kind."""
    t = F.coalesce(text, F.lit(""))
    vendor = t.contains(VENDOR_HINTS[0])
    for hint in VENDOR_HINTS[1:]:
        vendor = vendor | t.contains(hint)
    return F.array_sort(F.concat(
        _spans(t, 0, ASSIGN, t.rlike(ASSIGN), 2, MIN_ASSIGNED),
        _spans(t, 1, ACCESS, t.contains("AKIA")),
        _spans(t, 2, HEX, t.rlike(HEX)),
        _spans(t, 3, VENDOR, vendor),
        _spans(t, 4, JWT, t.contains("eyJ"))))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repositories, owners) from rows (hash, repository, owner, version), counted distinctly.

    Repositories that hold the same version (text) for an owner are one.
    """
    uses = found.groupBy("hash", "owner", "version").agg(F.min("repository").alias("repository")).select(
        "hash", "owner", "repository").distinct()
    by_owner = uses.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repository_col: str = "doc_id", example_owners: int = EXAMPLE_OWNERS,
                 example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``findings``, its spans with their ownership.

    A finding has start, place (in ``KINDS``), end, hash, repositories, owners and live. Findings
    of the kinds beyond the base ones are kept only when they look live.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    rows = with_row_numbers(docs.select(
        F.col(id_col).alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
        F.col(repository_col).cast("string").alias("repository"), F.md5(F.col(text_col)).alias("version"),
        candidates(F.col(text_col)).alias("found")), scratch, "candidates")
    each = (rows.where(F.size("found") > 0)
            .select("row", "doc_id", "owner", "repository", "version", F.explode("found").alias("f"))
            .select("row", "doc_id", "owner", "repository", "version", "f.*"))
    judged = each.join(ownership(each), "hash")
    live = (F.col("owners") < example_owners) & (F.col("repositories") < example_repositories)
    kept = judged.where((F.col("place") < len(BASE_KINDS)) | live)
    listed = (kept.groupBy("row", "doc_id")
              .agg(F.array_sort(F.collect_list(F.struct("start", "place", "end", "hash", "repositories", "owners",
                                                        live.alias("live")))).alias("findings")))
    kind = listed.schema["findings"].dataType.simpleString()
    with_none = (rows.where(F.size("found") == 0).select("row", "doc_id", F.array().cast(kind).alias("findings")))
    dropped = (each.select("row", "doc_id").distinct().join(listed.select("row"), "row", "left_anti")
               .select("row", "doc_id", F.array().cast(kind).alias("findings")))
    return listed.unionByName(with_none).unionByName(dropped).drop("row")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["place"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    f = F.col("findings")
    count = lambda p: F.size(F.filter(f, lambda s: s["place"] == p)).cast("long")
    return found.select(
        "doc_id", *[count(p).alias(f"n_{k}") for p, k in enumerate(BASE_KINDS)],
        F.sha2(_joined(F.filter(f, lambda s: s["place"] < len(BASE_KINDS))), 256).alias("base_sha256"),
        _joined(f).alias("spans"),
        F.size(F.filter(f, lambda s: s["live"])).cast("long").alias("n_live"))


def _sql_kind(place: int, pattern: str, value: str, least: int) -> str:
    p = pattern.replace("'", "''")
    return (f"SELECT rid, doc_id, source, t, {place} AS place, unnest(range(1, len(ms) + 1)) AS i, ms, gs, '{p}' AS re, "
            f"{least} AS least, {value} AS grp FROM (SELECT rid, doc_id, source, t, regexp_extract_all(t, '{p}') AS ms, "
            f"string_split_regex(t, '{p}') AS gs FROM d)")


def _op4_sql() -> str:
    kinds = " UNION ALL ".join(_sql_kind(p, r, v, n) for p, r, v, n in (
        (0, ASSIGN, "2", MIN_ASSIGNED), (1, ACCESS, "0", 0), (2, HEX, "0", 0), (3, VENDOR, "0", 0), (4, JWT, "0", 0)))
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    listed = f"string_agg({names}[place + 1] || ':' || st || ':' || en, ',' ORDER BY st, place)"
    base = f"place < {len(BASE_KINDS)}"
    assign = ASSIGN.replace("'", "''")
    live = f"(owners < {EXAMPLE_OWNERS} AND repositories < {EXAMPLE_REPOSITORIES})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
k AS ({kinds}),
m AS (SELECT rid, doc_id, source, t, place, least, ms[i] AS m,
             list_sum(list_transform(gs[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS st,
             CASE WHEN grp = 2 THEN regexp_extract(ms[i], '{assign}', 2) ELSE ms[i] END AS v FROM k),
f AS (SELECT *, CAST(st AS BIGINT) + length(m) AS en, sha256(v) AS h FROM m WHERE length(v) >= least),
r AS (SELECT h, coalesce(source, '~null~') AS owner, t, min(coalesce(CAST(doc_id AS VARCHAR), '~null~')) AS repository FROM f GROUP BY ALL),
o AS (SELECT h, count(DISTINCT owner) AS owners, count(DISTINCT owner || '/' || repository) AS repositories FROM r GROUP BY h),
j AS (SELECT f.*, {live} AS live FROM f JOIN o USING (h) WHERE {base} OR {live}),
g AS (SELECT rid, count(*) FILTER (place = 0) AS a, count(*) FILTER (place = 1) AS b, count(*) FILTER (place = 2) AS c,
             coalesce({listed} FILTER ({base}), '') AS base, {listed} AS spans, count(*) FILTER (live) AS n_live
      FROM j GROUP BY rid)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g USING (rid)
"""


OP4_SQL = _op4_sql()
