"""Operator 7: line dedup by a log-template tree (DataFrame functions only).

Lines are parsed by a tree of fixed depth: the first level is the number of
tokens, the next ``DEPTH`` levels are the leading tokens; a token with a digit
is a variable field, ``<*>``.  A leaf that holds several different lines and
recurs in ``MIN_DOCS`` documents is generalised: at every later position the
token that at least half of its documents share is constant, all else is a
variable field; lines that agree with at least ``LIKE`` of the constants
(over all tokens) follow the leaf's template.  Any other line is a template of
its own.  A template found in ``MIN_DOCS`` different documents recurs: its
first line (smallest doc_id, then line number) stays, all others are dropped.

Variable fields never stand for the content of a line: a line is masked only if
more than the share ``FIXED`` of its tokens, and that share of its bytes, is
constant (``header 3`` stays as it is), and follows its
leaf's template only if that share of its tokens and bytes after the leading
ones equals constants of the template; else the unmasked line is compared.

Long lines need no template: a line of at least ``LONG`` bytes (single spaces)
that stands unmasked in two different documents stays where it is first, and is
dropped everywhere else (``long=None`` leaves such lines to other operators).

Rows that travel are hashes, not lines; hot lines are pre-aggregated before
every shuffle, and the joins on templates read written tables, so that skewed
ones can be split.

Cases: null text has no lines and stays null, blank lines are never dropped,
a document that loses lines joins the rest unchanged, lines of any length are
parsed whole, repeated rows of one doc_id count as one document, rows with a
null doc_id are neither counted nor changed, extra columns are kept by
``drop_recurring``, an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

DEPTH = 3
MIN_DOCS = 10
LIKE = 0.7
FIXED = 0.5
LONG = 200  # bytes of a line that recurs from two documents on
FIELD = "<*>"
# Runs of blanks that are not one space; tokens with a digit, tried at token
# starts only.  Neither looks at ordinary text more than once.
BLANKS = r" *[\t\r\f\x0B][ \t\r\f\x0B]*| {2,}"
VARIABLE = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*"


def flattened(line: Column) -> Column:
    """The line with single spaces, trimmed.  A plain search spares most lines
    the replacement."""
    return F.trim(F.when(line.rlike(r"[\t\r\f\x0B]|  "), F.regexp_replace(line, BLANKS, " ")).otherwise(line))


def masked(flat: str | Column) -> Column:
    """A flattened line, variable fields masked."""
    flat = F.col(flat) if isinstance(flat, str) else flat
    return F.when(flat.rlike("[0-9]"), F.regexp_replace(flat, VARIABLE, FIELD)).otherwise(flat)


def tokens_of(form: Column) -> Column:
    return F.octet_length(form) - unspaced(form) + 1


def unspaced(line: Column) -> Column:
    """Bytes of a line without its spaces."""
    return F.octet_length(F.replace(line, F.lit(" "), F.lit("")))


def form_of(flat: Column, form: Column, fixed: float) -> Column:
    """The masked line, or the unmasked one where no more than ``fixed`` of the
    tokens, or less of the bytes, is constant."""
    constant = F.replace(form, F.lit(FIELD), F.lit(""))
    fields = (F.octet_length(form) - F.octet_length(constant)) / len(FIELD)
    enough = (fields < F.lit(1 - fixed) * tokens_of(form)) & (unspaced(constant) >= F.lit(fixed) * unspaced(flat))
    return F.when((flat == form) | enough, form).otherwise(flat)


def lines_of(docs: DataFrame, fixed: float = FIXED, long: int | None = LONG) -> DataFrame:
    """doc_id, line, form (masked text) and exact (hash of a long unmasked
    line) of every line that is not blank.  Lines are masked before they become
    rows, and step by step, so that none is masked twice."""
    flat = F.transform(F.split("text", "\n"), flattened)
    pairs = F.transform(flat, lambda f: F.struct(f.alias("flat"), masked(f).alias("form")))
    exact = lambda f: F.when(F.octet_length(f) >= long, F.xxhash64(f)) if long else F.lit(None).cast("long")
    rows = F.transform(pairs, lambda p: F.struct((form_of(p["flat"], p["form"], fixed) if fixed else p["form"]).alias("form"), exact(p["flat"]).alias("exact")))
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(rows).alias("line", "row"))
        .select("doc_id", "line", "row.form", "row.exact")
        .where(F.col("form") != "")
    )


def parsed(lines: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Add n_tokens and two hashes: of the form (pattern) and of the leaf of
    the tree (number of tokens and leading tokens)."""
    return lines.withColumn("n_tokens", tokens_of(F.col("form"))).select(
        "*", F.xxhash64("form").alias("pattern"), F.xxhash64("n_tokens", F.substring_index("form", " ", depth)).alias("leaf")
    )


def support(rows: DataFrame, key: str) -> DataFrame:
    """Number of different documents of each key."""
    return rows.select(key, "doc_id").distinct().groupBy(key).agg(F.count("*").alias("docs"))


def generalised(rows: DataFrame, depth: int, min_docs: int, like: float, fixed: float) -> DataFrame:
    """(pattern, template) of the lines that follow their leaf's template."""
    mixed = rows.groupBy("leaf").agg(F.min("pattern").alias("low"), F.max("pattern").alias("high")).where("low <> high").select("leaf")
    busy = written(support(rows, "leaf").where(F.col("docs") >= min_docs).select("leaf").join(mixed, "leaf", "left_semi"), "leaves")
    lines = rows.where(F.col("n_tokens") > depth).join(busy, "leaf", "left_semi")
    if fixed:  # unmasked lines stand for themselves
        lines = lines.where(~F.col("form").rlike("[0-9]"))
    # One row per different line of a busy leaf, with its number of documents.
    forms = written(
        lines.select("leaf", "pattern", "form", "doc_id").distinct().groupBy("leaf", "pattern", "form").agg(F.count("*").alias("docs")).withColumn("tokens", F.split("form", " ")).drop("form"),
        "forms",
    )
    places = forms.select("leaf", "docs", F.posexplode("tokens").alias("place", "token")).groupBy("leaf", "place", "token").agg(F.sum("docs").alias("docs"))
    # Most documents first, then the smaller token; the leading ones are constant by the tree.
    share = places.groupBy("leaf", "place").agg(F.min(F.struct((-F.col("docs")).alias("minus"), "token")).alias("top"), F.sum("docs").alias("all"))
    constant = share.where(-2 * F.col("top.minus") >= F.col("all")).select("leaf", "place", F.col("top.token").alias("token"))
    # Written, so that the join with the lines of a hot leaf can be split.
    leaf_form = written(constant.groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("place", "token"))).alias("constants")), "leaf-forms")
    equal = F.size(F.filter(F.col("tokens"), lambda t, i: t == F.element_at("constants", i)))
    follows = equal >= F.lit(like) * F.size("tokens")
    if fixed:
        later = F.slice("tokens", depth + 1, F.size("tokens"))
        shared = F.filter(later, lambda t, i: (t == F.element_at("constants", i + depth)) & (t != FIELD))
        size = lambda words: F.octet_length(F.array_join(words, ""))
        follows &= (F.size(shared) >= F.lit(fixed) * F.size(later)) & (size(shared) >= F.lit(fixed) * size(later))
    return forms.join(leaf_form, "leaf").where(follows).select("pattern", F.xxhash64("leaf", F.lit("leaf")).alias("template"))


def recurring_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, like: float = LIKE, fixed: float = FIXED, long: int | None = LONG) -> DataFrame:
    """(doc_id, line) of every line to drop; a line may be listed twice."""
    # Forms are written too: masked once, and read for busy leaves only.
    rows = written(parsed(lines_of(docs, fixed, long), depth).select("doc_id", "line", "pattern", "leaf", "exact", "n_tokens", "form"), "lines")
    general = written(generalised(rows, depth, min_docs, like, fixed), "templates")
    assigned = rows.select("doc_id", "line", "pattern").join(general, "pattern", "left").select("doc_id", "line", F.coalesce("template", "pattern").alias("template"))
    if not long:
        return again(written(assigned, "assigned"), min_docs)
    exact = rows.where(F.col("exact").isNotNull()).select("doc_id", "line", F.col("exact").alias("template"))
    return again(written(assigned, "assigned"), min_docs).unionByName(again(exact, 2))


def again(rows: DataFrame, min_docs: int) -> DataFrame:
    """Lines (doc_id, line, template) of templates of so many documents, but
    for each one's first."""
    often = support(rows, "template").where(F.col("docs") >= min_docs).select("template")
    first = rows.groupBy("template").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    dropped = written(first.join(often, "template", "left_semi"), "recurring")
    return rows.join(dropped, "template").where(F.struct("doc_id", "line") != F.col("first")).select("doc_id", "line")


def drop_recurring(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, like: float = LIKE, fixed: float = FIXED, long: int | None = LONG) -> DataFrame:
    """``docs`` without the lines of recurring templates, all columns kept,
    and columns n_lines and n_dropped (clashing ones are replaced)."""
    gone = recurring_lines(docs, depth, min_docs, like, fixed, long).groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_set("line").alias("gone_lines"))
    gone = written(gone, "dropped-lines")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone_lines", i)), "\n")
    n_dropped = F.coalesce(F.size("gone_lines"), F.lit(0)).cast("long")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return (
        docs.select(*names)
        # The same join at every size: texts are shuffled once.
        .join(gone.hint("merge"), docs["doc_id"].cast("long") == gone["gone_id"], "left")
        .select(
            *[F.when(F.col("gone_id").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c) for c in names],
            F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
            F.when(F.col("gone_id").isNull(), F.lit(0).cast("long")).otherwise(n_dropped).alias("n_dropped"),
        )
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    out = drop_recurring(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


# The same rules on line texts instead of hashes.
SQL = f"""
WITH raw AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents
), split AS (
  SELECT doc_id, i - 1 AS line, trim(regexp_replace(ls[i], '[ \\t\\r\\f\\x0B]+', ' ', 'g'), ' ') AS flat
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM raw WHERE doc_id IS NOT NULL)
), mask AS (
  SELECT *, regexp_replace(flat, '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS masked FROM split WHERE flat <> ''
), share AS (
  SELECT *, replace(masked, '{FIELD}', '') AS constant, len(string_split(masked, ' ')) AS n_tokens FROM mask
), l AS (
  SELECT doc_id, line, flat,
         CASE WHEN (strlen(masked) - strlen(constant)) / {len(FIELD)} < CAST({1 - FIXED} AS DOUBLE) * n_tokens
               AND strlen(replace(constant, ' ', '')) >= CAST({FIXED} AS DOUBLE) * strlen(replace(flat, ' ', '')) THEN masked ELSE flat END AS form
  FROM share
), n AS (
  SELECT *, string_split(form, ' ') AS tokens FROM l
), p AS (
  SELECT *, len(tokens) || chr(1) || array_to_string(tokens[1:{DEPTH}], chr(1)) AS leaf FROM n
), busy AS (
  SELECT leaf FROM p GROUP BY leaf HAVING count(DISTINCT doc_id) >= {MIN_DOCS} AND count(DISTINCT form) > 1
), forms AS (
  SELECT leaf, form, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs
  FROM p WHERE len(tokens) > {DEPTH} AND NOT regexp_matches(form, '[0-9]') AND leaf IN (SELECT leaf FROM busy) GROUP BY leaf, form
), places AS (
  SELECT leaf, i, tokens[i] AS token, sum(docs) AS docs
  FROM (SELECT leaf, docs, tokens, unnest(generate_series(1, len(tokens))) AS i FROM forms) GROUP BY ALL
), constant AS (
  SELECT leaf, i, token FROM (
    SELECT *, row_number() OVER (PARTITION BY leaf, i ORDER BY docs DESC, token) AS r, sum(docs) OVER (PARTITION BY leaf, i) AS whole FROM places
  ) WHERE r = 1 AND 2 * docs >= whole
), agreeing AS (
  SELECT f.leaf, f.form, count(*) AS equal, len(any_value(f.tokens)) AS n_tokens,
         count(*) FILTER (c.i > {DEPTH} AND c.token <> '{FIELD}') AS later,
         coalesce(sum(strlen(c.token)) FILTER (c.i > {DEPTH} AND c.token <> '{FIELD}'), 0) AS later_bytes,
         strlen(array_to_string(any_value(f.tokens)[{DEPTH + 1}:], '')) AS all_bytes
  FROM forms f JOIN constant c ON c.leaf = f.leaf AND f.tokens[c.i] = c.token
  GROUP BY f.leaf, f.form
), general AS (
  SELECT leaf, form FROM agreeing
  WHERE equal >= CAST({LIKE} AS DOUBLE) * n_tokens AND later >= CAST({FIXED} AS DOUBLE) * (n_tokens - {DEPTH})
    AND later_bytes >= CAST({FIXED} AS DOUBLE) * all_bytes
), assigned AS (
  SELECT p.doc_id, p.line, CASE WHEN g.form IS NULL THEN 'form ' || p.form ELSE 'leaf ' || p.leaf END AS template, {MIN_DOCS} AS least
  FROM p LEFT JOIN general g ON g.form = p.form
  UNION ALL
  SELECT doc_id, line, 'exact ' || flat, 2 FROM l WHERE strlen(flat) >= {LONG}
), often AS (
  SELECT template, min(struct_pack(d := doc_id, l := line)) AS first FROM assigned GROUP BY template HAVING count(DISTINCT doc_id) >= min(least)
), gone AS (
  SELECT a.doc_id, list(DISTINCT a.line) AS lines FROM assigned a JOIN often USING (template)
  WHERE struct_pack(d := a.doc_id, l := a.line) <> often.first GROUP BY a.doc_id
)
SELECT r.doc_id, CAST(coalesce(len(r.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(g.lines), 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(CASE WHEN g.doc_id IS NULL THEN r.text
         ELSE array_to_string(list_filter(r.ls, lambda x, i: NOT list_contains(g.lines, i - 1)), chr(10)) END, '')) AS kept_sha256
FROM raw r LEFT JOIN gone g ON g.doc_id = r.doc_id
"""
