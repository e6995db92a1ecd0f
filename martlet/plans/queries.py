"""Query registry: each key binds an operator to the driver's tables and
carries the equivalent DuckDB SQL (the oracle), or ``None`` where the result is
only checkable by invariants computed on both sides.

Every query reads whole tables (or data Spark derives from them); no row caps
except where the cap is the feature (top-k, row limit).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.functions.stopwords import default_stop_words, sql_in_list
from martlet.operators import cluster, columns, enrich, profile, rows, text
from martlet.operators.index import with_row_index
from martlet.plans import jobs
from martlet.plans.fixtures import dirty, dirty_part, table, with_dirty, with_dirty_part
from martlet.session import shared_dir
from martlet.sources import colocated, files, tables

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_STOP = sql_in_list(default_stop_words())
_TOKENS = r"unnest(regexp_split_to_array(lower({col}), '\W+'))"

# --------------------------------------------------------------------------- text


@register("word_count", f"""
select word, count(*) as "count"
from (select {_TOKENS.format(col='text')} as word from documents)
where word not in ({_STOP})
group by word
""")
def q_word_count(spark, sf):
    return text.word_count(table(spark, sf, "documents"), "text")


@register("word_count_conversations", f"""
select word, count(*) as "count"
from (select {_TOKENS.format(col='text')} as word from conversations)
where word not in ({_STOP})
group by word
""")
def q_word_count_conversations(spark, sf):
    return text.word_count(table(spark, sf, "conversations"), "text")


@register("word_topk", f"""
select word, count(*) as "count"
from (select {_TOKENS.format(col='text')} as word from documents)
where word not in ({_STOP})
group by word
order by "count" desc, word
limit 20
""")
def q_word_topk(spark, sf):
    return text.word_topk(table(spark, sf, "documents"), "text", k=20)


@register("stopword_filter", rf"""
select conv_id, turn,
  len(regexp_split_to_array(lower(text), '\W+')) as n_tokens,
  len(list_filter(regexp_split_to_array(lower(text), '\W+'), lambda w: w not in ({_STOP}))) as n_kept
from conversations where text is not null
""")
def q_stopword_filter(spark, sf):
    return text.token_counts(table(spark, sf, "conversations"), "text", ["conv_id", "turn"])


# ----------------------------------------------------------------- row cleaning
_KEYS = ["l_orderkey", "l_linenumber"]


def _clean_sql(cols):
    conds = []
    for c in cols:
        x = f"try_cast({c} as float)"
        conds += [f"{c} is not null", f"{x} is not null", f"not isnan({x})", f"{x} < 100", f"{x} >= 0"]
    return " and ".join(conds)


@register("clean_numeric", with_dirty(f"""
select l_orderkey, l_linenumber, try_cast(qty as float) as qty, try_cast(tax as float) as tax
from dirty where {_clean_sql(['qty', 'tax'])}
"""))
def q_clean_numeric(spark, sf):
    return rows.clean_numeric(dirty(spark, sf), ["qty", "tax"], keys=_KEYS)


@register("cast_numeric", with_dirty("""
select l_orderkey, l_linenumber, try_cast(qty as float) as qty, try_cast(disc as float) as disc,
  try_cast(tax as float) as tax, try_cast(price as float) as price
from dirty
"""))
def q_cast_numeric(spark, sf):
    return rows.cast_numeric(dirty(spark, sf), ["qty", "disc", "tax", "price"], "float")


@register("drop_incomplete", with_dirty("""
select * from dirty
where l_orderkey is not null and l_linenumber is not null and qty is not null
  and disc is not null and tax is not null and price is not null
"""))
def q_drop_incomplete(spark, sf):
    return rows.drop_incomplete(dirty(spark, sf))


@register("range_filter", with_dirty("""
select * from (
  select l_orderkey, l_linenumber, try_cast(qty as float) as qty, try_cast(disc as float) as disc,
    try_cast(tax as float) as tax
  from dirty)
where qty < 100 and disc < 100 and tax < 100 and qty >= 0 and disc >= 0 and tax >= 0
"""))
def q_range_filter(spark, sf):
    casted = rows.cast_numeric(dirty(spark, sf).select(*_KEYS, "qty", "disc", "tax"), ["qty", "disc", "tax"])
    return rows.range_filter(casted, ["qty", "disc", "tax"], upper=100.0, lower=0.0)


@register("hidden_column_filter", with_dirty("""
select l_orderkey, l_linenumber, qty from dirty where try_cast(price as double) < 50000
"""))
def q_hidden_column_filter(spark, sf):
    return rows.hidden_column_filter(dirty(spark, sf), {"price": 50000.0}, keep=[*_KEYS, "qty"])


_STOP_ANY = r"""
select conv_id, turn, word from (
  select conv_id, turn, unnest(regexp_split_to_array(lower(text), '\W+')) as word from conversations)
where word not in ({stop})
"""


@register("stop_list_filter", _STOP_ANY.format(stop=_STOP))
def q_stop_list_filter(spark, sf):
    toks = text.tokenize(table(spark, sf, "conversations"), "text", keep=["conv_id", "turn"])
    return rows.stop_list_filter(toks, "word", default_stop_words())


@register("limit_rows", "select * from orders order by o_orderkey limit 5000")
def q_limit_rows(spark, sf):
    return rows.limit_rows(table(spark, sf, "orders"), 5000, order_by=["o_orderkey"])


@register("limit_rows_half", """
select * from lineitem order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
limit 30000
""")
def q_limit_rows_half(spark, sf):
    """A cap inside a table whose keys repeat, cut in one partition."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    return rows.limit_rows(table(spark, sf, "lineitem"), 30000, order_by=order)


@register("row_index", "select *, row_number() over (order by o_orderkey) - 1 as row_index from orders")
def q_row_index(spark, sf):
    return with_row_index(table(spark, sf, "orders"), "o_orderkey")


@register("row_index_text", """
select page_id, url, row_number() over (order by url, page_id) - 1 as row_index from pages
""")
def q_row_index_text(spark, sf):
    return with_row_index(table(spark, sf, "pages").select("page_id", "url"), "url", tiebreak=["page_id"])


# -------------------------------------------------------------------- profiling
def _missing_sql(name, kind):
    if kind == "string":
        cond = (f"coalesce(contains({name}, 'None') or contains({name}, 'NULL') or contains({name}, 'unknown')"
                f" or {name} = '' or {name} is null or isnan(try_cast({name} as double)), false)")
    else:
        cond = f"{name} is null"
    return (f"select '{name}' as column_name, "
            f"round(cast(count(*) filter (where {cond}) as double) / count(*) * 100, 6) as missing_pct from dirty")


_DIRTY_COLS = [("l_orderkey", "num"), ("l_linenumber", "num"), ("qty", "string"), ("disc", "string"),
               ("tax", "string"), ("price", "string")]


@register("missing_profile", with_dirty(" union all ".join(_missing_sql(c, k) for c, k in _DIRTY_COLS)))
def q_missing_profile(spark, sf):
    return profile.missing_profile(dirty(spark, sf))


def _wide_columns():
    """207 text columns over all columns of lineitem, with the dirty cells of a wide product table."""
    base = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
    return [(f"w{j}", base[j % len(base)], j) for j in range(207)]


def _wide_sql(text_of):
    cells = ", ".join(
        f"case when (l_orderkey + {j}) % {j % 13 + 2} = 0 then null when (l_orderkey + {j}) % 11 = 0 then 'unknown' "
        f"when (l_orderkey + {j}) % 17 = 0 then 'NaN' when (l_orderkey + {j}) % 19 = 0 then '' "
        f"else {text_of.format(c)} end as {name}" for name, c, j in _wide_columns())
    return f"select {cells} from "


_WIDE_MISSING = ", ".join(
    f"round(cast(count(*) filter (where coalesce(contains({c}, 'None') or contains({c}, 'NULL') or contains({c}, 'unknown') "
    f"or {c} = '' or {c} is null or isnan(try_cast({c} as double)), false)) as double) / count(*) * 100, 6) as {c}"
    for c, _, _ in _wide_columns())


@register("missing_profile_wide", f"""
with wide as ({_wide_sql('cast({} as varchar)')} lineitem)
select column_name, missing_pct
from (unpivot (select {_WIDE_MISSING} from wide) on columns(*) into name column_name value missing_pct)
""")
def q_missing_profile_wide(spark, sf):
    """A2 at the width of the studied table.

    A column of lineitem is rendered as text once for all cells made of it, and those are profiled together."""
    made = sorted(_wide_columns(), key=lambda column: column[1])
    lineitem = table(spark, sf, "lineitem")
    texts = lineitem.select("l_orderkey", *[F.col(c).cast("string").alias(f"{c}_text") for c in sorted({c for _, c, _ in made})])
    wide = spark.sql(_wide_sql("{}_text") + "{texts}", texts=texts)
    return profile.missing_profile(wide, [name for name, _, _ in made])


@register("feature_columns", "select p_name, p_size, p_retailprice from part")
def q_feature_columns(spark, sf):
    """P5: the useful columns less the metadata columns."""
    part = table(spark, sf, "part")
    return columns.project(part, columns.feature_columns(["p_name", "p_partkey", "p_size", "p_retailprice"], ["p_partkey", "p_comment"]))


@register("drop_sparse_columns", with_dirty("select l_orderkey, l_linenumber, qty, tax, price from dirty"))
def q_drop_sparse_columns(spark, sf):
    d = dirty(spark, sf)
    return columns.drop_sparse_columns(d, profile.missing_percentages(d), 50.0)


@register("explore_prune", with_dirty("""
select l_orderkey, l_linenumber, qty, tax from dirty
where l_orderkey is not null and l_linenumber is not null and qty is not null and tax is not null
"""))
def q_explore_prune(spark, sf):
    useful = [*_KEYS, "qty", "disc", "tax", "price"]
    return jobs.explore(dirty(spark, sf), useful, metadata=["l_comment"], name_tokens=["price"], strict=False).pruned


@register("explore", with_dirty(" union all ".join(
    f"select '{c}' as column_name, count(*) as n_rows, {_missing_sql(c, k).split('as column_name, ')[1].removesuffix(' from dirty')}, "
    f"count({c}) as \"count\", round(avg(try_cast({c} as double)), 6) as mean, round(stddev_samp(try_cast({c} as double)), 6) as stddev, "
    f"cast(min({c}) as varchar) as \"min\", cast(max({c}) as varchar) as \"max\", {c not in ('disc', 'price')} as kept, "
    f"(select count(*) from dirty where qty is not null and tax is not null) as n_pruned from dirty" for c, k in _DIRTY_COLS)))
def q_explore(spark, sf):
    """J-D's counts, missing percentages and descriptions of all columns, and what it keeps."""
    found = jobs.explore(dirty(spark, sf), [*_KEYS, "qty", "tax"], metadata=["l_comment"], name_tokens=["price"])
    figures = found.figures.withColumns({c: F.round(c, 6) for c in ("missing_pct", "mean", "stddev")})
    return figures.crossJoin(found.pruned.agg(F.count(F.lit(1)).alias("n_pruned")))


@register("explore_raw_file", with_dirty("""
select cast(l_orderkey as integer) as l_orderkey, l_linenumber, qty, cast(tax as double) as tax from dirty
where qty is not null and qty <> '' and tax is not null
"""))
def q_explore_raw_file(spark, sf):
    """J-D from a raw file: TSV with hyphenated header names -> inferred types ->
    normalised names -> drop metadata/name tokens -> profile -> drop sparse ->
    project -> drop incomplete. (Empty TSV fields read back as NULL.)"""
    raw = dirty(spark, sf)
    raw = raw.toDF(*[c.replace("_", "-") for c in raw.columns])
    path = files.write_tsv(raw, shared_dir(spark, "explore_raw"))
    df = columns.normalise_names(files.tsv_scan(spark, path))
    useful = [*_KEYS, "qty", "disc", "tax", "price"]
    return jobs.explore(df, useful, metadata=["l_comment"], name_tokens=["price"], strict=False).pruned


_NUM_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("row_count", "select count(*) as n_rows from lineitem")
def q_row_count(spark, sf):
    return profile.row_count(table(spark, sf, "lineitem"))


@register("describe_numeric", " union all ".join(
    f"select '{c}' as column_name, count({c}) as \"count\", round(avg({c}), 6) as mean, "
    f"round(stddev_samp({c}), 6) as stddev, round(min({c}), 6) as \"min\", round(max({c}), 6) as \"max\" "
    f"from lineitem" for c in _NUM_LINE))
def q_describe_numeric(spark, sf):
    return profile.describe_numeric(table(spark, sf, "lineitem"), _NUM_LINE)


@register("describe_all", with_dirty(" union all ".join(
    f"select '{c}' as column_name, count({c}) as \"count\", round(avg(try_cast({c} as double)), 6) as mean, "
    f"round(stddev_samp(try_cast({c} as double)), 6) as stddev, cast(min({c}) as varchar) as \"min\", "
    f"cast(max({c}) as varchar) as \"max\" from dirty" for c, _ in _DIRTY_COLS)))
def q_describe_all(spark, sf):
    return profile.describe_all(dirty(spark, sf))


_BOX_SQL = """
with s as ({union}),
q as (select column_name, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as med,
             quantile_cont(v, 0.75) as q3 from s group by column_name)
select q.column_name, round(any_value(q1), 6) as q1, round(any_value(med), 6) as median,
  round(any_value(q3), 6) as q3, round(any_value(q3 - q1), 6) as iqr,
  round(min(v) filter (where v >= q1 - 1.5 * (q3 - q1)), 6) as whisker_low,
  round(max(v) filter (where v <= q3 + 1.5 * (q3 - q1)), 6) as whisker_high,
  count(*) filter (where v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1)) as n_outliers
from q join s on q.column_name = s.column_name
group by q.column_name
"""


@register("boxplot_stats", _BOX_SQL.format(union=" union all ".join(
    f"select '{c}' as column_name, cast({c} as double) as v from lineitem" for c in _NUM_LINE)))
def q_boxplot_stats(spark, sf):
    return profile.boxplot_stats(spark, table(spark, sf, "lineitem"), _NUM_LINE)


# ------------------------------------------------------------ column operators
@register("project_cols", "select p_partkey, p_name, p_retailprice from part")
def q_project_cols(spark, sf):
    return columns.project(table(spark, sf, "part"), ["p_partkey", "p_name", "p_retailprice"])


@register("drop_named", """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_linestatus from lineitem
""")
def q_drop_named(spark, sf):
    return columns.drop_named(table(spark, sf, "lineitem"), ["l_shipdate", "l_returnflag", "l_comment"])


@register("drop_by_name_token", "select page_id, html from pages")
def q_drop_by_name_token(spark, sf):
    return columns.drop_by_name_token(table(spark, sf, "pages"), "url")


@register("select_by_type", "select p_partkey, p_retailprice from part")
def q_select_by_type(spark, sf):
    return columns.select_by_type(table(spark, sf, "part"), "double", "bigint")


_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("schema_report", """
with m as (
  select cast(ordinal_position as integer) as position, column_name,
    case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
      when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT' then 'float'
      else lower(data_type) end as data_type,
    is_nullable = 'YES' as nullable
  from information_schema.columns where table_name = 'lineitem'),
c as (""" + " union all ".join(f"select '{c}' as column_name, count({c}) as n_non_null from lineitem"
                               for c in _LINE_COLS) + """)
select m.position, m.column_name, m.data_type, m.nullable, c.n_non_null
from m join c on m.column_name = c.column_name
""")
def q_schema_report(spark, sf):
    return columns.schema_report(spark, table(spark, sf, "lineitem"))


@register("layout_report", """
select cast(6 as bigint) as n_files, count(*) as n_rows, true as bytes_known, true as spread, cast(6 as bigint) as n_partitions, count(*) as n_partition_rows
from lineitem
""")
def q_layout_report(spark, sf):
    """P9 of files and partitions: lineitem laid out in six sorted files."""
    path = tables.write_sorted(table(spark, sf, "lineitem"), shared_dir(spark, "layout_report"), "l_orderkey", num_partitions=6)
    files_ = columns.layout_report(spark, path).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("bytes") > 0).alias("bytes_known"),
        (F.max("n_rows") < F.sum("n_rows") / 2).alias("spread"))
    parts = columns.partition_report(spark.read.parquet(path).repartition(6, "l_orderkey")).agg(
        F.count(F.lit(1)).alias("n_partitions"), F.sum("n_rows").alias("n_partition_rows"))
    return files_.crossJoin(parts)


@register("normalise_names", "select * from part")
def q_normalise_names(spark, sf):
    part = table(spark, sf, "part")
    hyphenated = part.toDF(*[c.replace("_", "-") for c in part.columns])
    return columns.normalise_names(hyphenated)


# ------------------------------------------------------------------------ joins
@register("add_null_column", "select doc_id, lang, source, n_chars, cast(null as integer) as prediction from documents")
def q_add_null_column(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return enrich.add_null_column(enrich.add_null_column(docs, "prediction"), "prediction")


@register("enrich_left_join", """
select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
from documents d left join labels l on d.doc_id = l.doc_id
""")
def q_enrich_left_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return enrich.enrich_left_join(docs, table(spark, sf, "labels"), "doc_id", ["quality", "toxic"])


@register("enrich_left_join_laid_out", """
with x as (select case when l_orderkey % 3 = 0 then 7 when l_orderkey % 5 = 0 then null else l_partkey end as p_partkey,
             l_orderkey, l_linenumber, l_quantity from lineitem)
select x.*, p.p_size, p.p_brand from x left join part p on x.p_partkey = p.p_partkey
""")
def q_enrich_left_join_laid_out(spark, sf):
    """J1 on tables bucketed alike, with one key on a third of the rows and many NULL keys."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 7).when(F.col("l_orderkey") % 5 == 0, None).otherwise(F.col("l_partkey"))
    lines = table(spark, sf, "lineitem").select(key.cast("long").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity")
    base = shared_dir(spark, "laid_out")
    tag = base.rsplit("-", 1)[-1]
    left, right = f"martlet_lines_{tag}", f"martlet_parts_{tag}"
    hot = colocated.lay_out_left(lines, left, f"{base}/left", "p_partkey", 16)
    colocated.lay_out_right(table(spark, sf, "part").select("p_partkey", "p_size", "p_brand"), right, f"{base}/right", "p_partkey", 16, hot)
    return colocated.colocated_left_join(spark, left, right, "p_partkey", ["p_size", "p_brand"])


@register("write_back_laid_out", """
select cast(p_partkey as varchar) as code, p_name, cast(p_size % 5 as integer) as prediction from part
""")
def q_write_back_laid_out(spark, sf):
    """J-C twice over one layout of the wide table; the second prediction replaces the first."""
    part = table(spark, sf, "part")
    wide = enrich.add_null_column(part.select(F.col("p_partkey").cast("string").alias("code"), "p_name"), "prediction")
    base = shared_dir(spark, "write_back")
    laid = jobs.lay_out_wide(wide, "martlet_wide_" + base.rsplit("-", 1)[-1], base, "code", 8)
    for modulus in (7, 5):
        mart = part.select(F.col("p_partkey").cast("string").alias("code"), (F.col("p_size") % modulus).cast("int").alias("prediction"))
        enriched = jobs.write_back_laid_out(laid, mart)
    return enriched


@register("enrich_left_join_dup", """
select o.*, l.l_linenumber, l.l_quantity
from orders o left join lineitem l on o.o_orderkey = l.l_orderkey
""")
def q_enrich_left_join_dup(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return enrich.enrich_left_join(table(spark, sf, "orders"), lines, "o_orderkey",
                                   ["l_linenumber", "l_quantity"], on_duplicate="keep")


# ------------------------------------------------------------------- clustering
_CENTRE_KEYS = [0, 400, 800, 1200, 1600]


@register("kmeans_assign_fixed", f"""
with c as (
  select row_number() over (order by p_partkey) - 1 as cid, cast(p_size as double) as cs, p_retailprice as cp
  from part where p_partkey in ({", ".join(map(str, _CENTRE_KEYS))})),
d as (
  select p.p_partkey, c.cid,
    (cast(p.p_size as double) - cs) * (cast(p.p_size as double) - cs)
      + (p.p_retailprice - cp) * (p.p_retailprice - cp) as dist
  from part p, c)
select p_partkey, cast(first(cid order by dist, cid) as integer) as prediction from d group by p_partkey
""")
def q_kmeans_assign_fixed(spark, sf):
    part = table(spark, sf, "part")
    feats = ["p_size", "p_retailprice"]
    # k rows: bounded, read on the driver to build the distance expressions.
    centres = [tuple(float(r[c]) for c in feats) for r in
               part.where(F.col("p_partkey").isin(_CENTRE_KEYS)).orderBy("p_partkey").select(*feats).collect()]
    return cluster.assign_nearest(part.select("p_partkey", *feats), feats, centres).select("p_partkey", "prediction")


@register("kmeans_blobs", "select p_partkey, cast(p_partkey % 5 as integer) as cluster from part")
def q_kmeans_blobs(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        ((F.col("p_partkey") % 5) * 1000 + F.col("p_size")).cast("double").alias("x"),
        (F.col("p_retailprice") / 1000).alias("y"))
    feats = cluster.assemble(part, ["x", "y"])
    model = cluster.fit_kmeans(feats, k=5, seed=42)
    return cluster.relabel_by_centre_order(model.transform(feats), model, dim=0).select("p_partkey", "cluster")


# Every pair of vectors: the definition that the statistics per cluster replace.
_SILHOUETTE_SQL = """
with e as (select vec_id, label, cast(embedding as double[]) as v from embeddings),
sz as (select label, count(*) as n from e group by label),
d as (select a.vec_id, a.label as la, b.label as lb, sum(pow(list_distance(a.v, b.v), 2)) as s
      from e a join e b on a.vec_id <> b.vec_id group by a.vec_id, a.label, b.label),
m as (select d.vec_id, d.la, d.lb,
        case when d.la = d.lb then d.s / (sz.n - 1) else d.s / sz.n end as mean_d
      from d join sz on sz.label = d.lb),
p as (select vec_id, la as label, max(case when la = lb then mean_d end) as a,
        min(case when la <> lb then mean_d end) as b from m group by vec_id, la),
s as (select vec_id, label, case when a is null then 0 else (b - a) / greatest(a, b) end as silhouette from p)
"""


def _embedded(spark, sf):
    return cluster.array_features(table(spark, sf, "embeddings"), "embedding").select("vec_id", "label", "features")


@register("silhouette_by_label", _SILHOUETTE_SQL + "select round(avg(silhouette), 6) as silhouette from s")
def q_silhouette_by_label(spark, sf):
    return cluster.silhouette_rows(_embedded(spark, sf), prediction_col="label").agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


@register("silhouette_rows", _SILHOUETTE_SQL + "select vec_id, label, round(silhouette, 6) as silhouette from s")
def q_silhouette_rows(spark, sf):
    return cluster.silhouette_rows(_embedded(spark, sf), prediction_col="label").select("vec_id", "label", F.round("silhouette", 6).alias("silhouette"))


@register("silhouette_clusters", _SILHOUETTE_SQL + """
select label, count(*) as size, round(avg(silhouette), 6) as silhouette from s group by label
""")
def q_silhouette_clusters(spark, sf):
    return cluster.silhouette_by_cluster(_embedded(spark, sf), prediction_col="label").withColumn("silhouette", F.round("silhouette", 6))


@register("cluster_sizes", "select label, count(*) as size from embeddings group by label")
def q_cluster_sizes(spark, sf):
    return cluster.cluster_sizes(table(spark, sf, "embeddings"), "label")


@register("assemble_vectors", "select p_partkey, [cast(p_size as double), p_retailprice] as features from part")
def q_assemble_vectors(spark, sf):
    v = cluster.assemble(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return v.select("p_partkey", cluster.vector_as_array("features").alias("features"))


_LINE_FEATS = ["l_quantity", "l_discount", "l_tax"]


@register("kmeans_fit_invariants", """
select cast(5 as bigint) as k, count(*) as n_rows, count(*) as sum_sizes, true as ids_in_range, true as sizes_agree from lineitem
""")
def q_kmeans_fit_invariants(spark, sf):
    """The summary's k and sizes (M5), and the sizes counted from every row's cluster."""
    feats = cluster.assemble(table(spark, sf, "lineitem"), _LINE_FEATS)
    model = cluster.fit_kmeans(feats, k=5, seed=42)
    summary = cluster.model_summary(model)
    told = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in summary["cluster_sizes"]]), F.col("prediction") + 1)
    return cluster.cluster_sizes(model.transform(feats)).agg(
        F.lit(summary["k"]).cast("bigint").alias("k"), F.sum("size").alias("n_rows"), F.sum(told).alias("sum_sizes"),
        F.bool_and(F.col("prediction").between(0, summary["k"] - 1)).alias("ids_in_range"), F.bool_and(F.col("size") == told).alias("sizes_agree"))


@register("clusterize_invariants", """
select count(*) as n_rows, count(*) as sum_sizes, cast(5 as bigint) as k, true as silhouette_in_range from part
""")
def q_clusterize_invariants(spark, sf):
    mart = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("code"),
                                          F.col("p_size").cast("float").alias("size_g"),
                                          (F.col("p_retailprice") / 10).cast("float").alias("price_g"))
    res = jobs.clusterize(mart, ["size_g", "price_g"], k=5, seed=42)
    return res.predictions.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(sum(res.sizes)).cast("bigint").alias("sum_sizes"),
        F.lit(len(res.sizes)).cast("bigint").alias("k"),
        F.lit(-1.0 <= res.silhouette <= 1.0).alias("silhouette_in_range"))


@register("model_roundtrip", "select cast(5 as bigint) as k, count(*) as n_rows, cast(0 as bigint) as n_mismatch from part")
def q_model_roundtrip(spark, sf):
    feats = cluster.assemble(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    model = cluster.fit_kmeans(feats, k=5, seed=42)
    loaded = cluster.load_model(cluster.save_model(model, shared_dir(spark, "kmeans_model")))
    both = loaded.setPredictionCol("p2").transform(model.transform(feats))
    return both.agg(F.lit(len(loaded.clusterCenters())).cast("bigint").alias("k"),
                    F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(F.col("prediction") != F.col("p2")).alias("n_mismatch"))


# ------------------------------------------------------------- sources / sinks
@register("tsv_scan", """
select cast(p_partkey as integer) as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part
""")
def q_tsv_scan(spark, sf):
    path = files.write_tsv(table(spark, sf, "part"), shared_dir(spark, "tsv_scan"))
    return files.tsv_scan(spark, path)


_BAD_EVERY = 1009


@register("tolerant_load", f"""
select o_orderkey, o_custkey, o_orderstatus || chr(9) || 'a' || chr(92) || 'b' || chr(10) as o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority from orders where o_orderkey % {_BAD_EVERY} <> 0
""")
def q_tolerant_load(spark, sf):
    """The text is read once, and its good rows go into a published table."""
    orders = table(spark, sf, "orders")
    good, budget = files.tolerant_load(spark, _broken_orders(spark, orders), orders.schema, max_bad_rows=1000, deferred=True)
    base = shared_dir(spark, "tolerant_table")
    name = "martlet_import_" + base.rsplit("-", 1)[-1]
    tables.publish(spark, good, name, base, checks=[budget.check])
    return spark.table(name)


def _broken_orders(spark, orders):
    """A file with hyphenated names in another order, bad prices, and tabs, backslashes
    and line ends in a text cell."""
    broken = orders.select(
        F.col("o_orderdate").alias("o-orderdate"),
        F.when(F.col("o_orderkey") % _BAD_EVERY == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o-totalprice"),
        F.concat("o_orderstatus", F.lit("\ta\\b\n")).alias("o-orderstatus"),
        F.col("o_custkey").alias("o-custkey"), "o_orderpriority", "o_orderkey")
    return files.write_tsv(broken, shared_dir(spark, "tolerant_load"))


@register("tolerant_load_rejected", f"""
select o_orderkey, 'o_totalprice' as reason, cast(6 as integer) as n_fields, true as placed from orders where o_orderkey % {_BAD_EVERY} = 0
""")
def q_tolerant_load_rejected(spark, sf):
    """The rejected lines with their reason; lines are numbered from 2, after the header."""
    orders = table(spark, sf, "orders")
    cells = F.split("value", "\t", -1)
    return files.tolerant_import(spark, _broken_orders(spark, orders), orders.schema).rejected.select(
        cells[5].cast("long").alias("o_orderkey"), "reason", F.size(cells).alias("n_fields"), (F.col("line") > 1).alias("placed"))


@register("tolerant_load_header_row", """
select cast(page_id as varchar) as page_id, url from pages union all select 'page_id', 'url' from pages where page_id % 50 = 0
""")
def q_tolerant_load_header_row(spark, sf):
    """Data rows that read like the header line stay."""
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string"), "url")
    alike = table(spark, sf, "pages").where("page_id % 50 = 0").select(F.lit("page_id").alias("page_id"), F.lit("url").alias("url"))
    path = files.write_tsv(pages.unionByName(alike), shared_dir(spark, "header_row"))
    return files.tolerant_load(spark, path, pages.schema)[0]


@register("source_by_format", "select * from orders")
def q_source_by_format(spark, sf):
    return files.read_source(spark, "parquet", f"{sf.rstrip('/')}/orders.parquet")


@register("sorted_layout", "select * from part")
def q_sorted_layout(spark, sf):
    path = tables.write_sorted(table(spark, sf, "part"), shared_dir(spark, "sorted_layout"), "p_partkey")
    return spark.read.parquet(path)


def _ddl(df):
    return ", ".join(f"{tables.quote(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)


@register("table_lifecycle", "select * from orders")
def q_table_lifecycle(spark, sf):
    orders = table(spark, sf, "orders")
    name = "martlet_lifecycle_" + shared_dir(spark, "x").rsplit("-", 1)[-1]
    tables.drop_table(spark, name)
    tables.create_table(spark, name, _ddl(orders), shared_dir(spark, "table_lifecycle"))
    tables.insert_into(orders, name)
    tables.truncate_table(spark, name)
    tables.insert_into(orders, name)
    return spark.table(name)


@register("publish_replace", "select * from orders")
def q_publish_replace(spark, sf):
    orders = table(spark, sf, "orders")
    base = shared_dir(spark, "publish")
    name = "martlet_publish_" + base.rsplit("-", 1)[-1]
    tables.publish(spark, orders, name, base)
    tables.publish(spark, spark.table(name), name, base)   # republish from itself: never doubles
    return spark.table(name)


# ----------------------------------------------------------------- flagship job
_FLAG_FEATS = ["size_g", "price_g"]


def _flag_clean_sql():
    return _clean_sql(_FLAG_FEATS)


@register("mart_end_to_end", with_dirty_part(f"""
, clean as (select code from dirty_part where {_flag_clean_sql()})
select count(*) as n_rows, count(c.code) as n_with_prediction, cast(5 as bigint) as n_clusters
from dirty_part d left join clean c on d.code = c.code
"""))
def q_mart_end_to_end(spark, sf):
    enriched, _ = jobs.mart_end_to_end(dirty_part(spark, sf), "code", _FLAG_FEATS, k=5, seed=42)
    return jobs.mart_invariants(enriched)


@register("mart_chain", with_dirty_part(f"""
, clean as (select code from dirty_part where {_flag_clean_sql()})
select count(*) as n_rows, count(c.code) as n_with_prediction, cast(5 as bigint) as n_clusters
from dirty_part d left join clean c on d.code = c.code
"""))
def q_mart_chain(spark, sf):
    """J-G: the three stages as separate steps that hand over state only
    through published tables (wide -> mart -> mart+prediction -> wide)."""
    base = shared_dir(spark, "chain")
    tag = base.rsplit("-", 1)[-1]
    wide_name, mart_name = f"martlet_wide_{tag}", f"martlet_mart_{tag}"
    wide = enrich.add_null_column(dirty_part(spark, sf), "prediction")
    tables.publish(spark, wide, wide_name, f"{base}/{wide_name}")
    cfg = jobs.MartConfig(wide_name, mart_name, base, key="code", features=_FLAG_FEATS, k=5, seed=42)
    jobs.run_stages(spark, ["preprocess", "clusterize", "write"], cfg)
    return jobs.mart_invariants(spark.table(wide_name))


# Five groups well apart, some rows dirty: every row has one right cluster, so these
# queries compare clusters row by row, numbered by the order of their centres.
_BLOB_ROWS = """
select cast(p_partkey as varchar) as code,
  case when p_partkey % 7 = 0 or p_partkey % 11 = 0 or p_partkey % 13 = 0 then null
       else cast(p_partkey % 5 as integer) end as cluster
from part
"""


# The cells of _blobs that are numbers, as single-precision floats like the mart's, after each filter.
_BLOB_SPREAD_SQL = """
with v as (select cast(case when p_partkey % 13 = 0 then 150 else (p_partkey % 5) * 18 + p_size / 10.0 end as float) as x, p_retailprice / 1000 < 0.95 as near
           from part where p_partkey % 7 <> 0 and p_partkey % 11 <> 0),
s as (select 'cast' as stage, cast(x as double) as x from v union all select 'extra', cast(x as double) from v where near
      union all select 'upper', cast(x as double) from v where near and x < 100
      union all select 'lower', cast(x as double) from v where near and x < 100 and x >= 0),
q as (select stage, quantile_cont(x, 0.25) as q1, quantile_cont(x, 0.5) as median, quantile_cont(x, 0.75) as q3 from s group by stage)
select q.stage, 'x' as column_name, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,
  round(min(x) filter (where x >= q1 - 1.5 * (q3 - q1)), 6) as whisker_low,
  round(max(x) filter (where x <= q3 + 1.5 * (q3 - q1)), 6) as whisker_high,
  count(*) filter (where x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1)) as n_outliers
from q join s on q.stage = s.stage group by q.stage, q1, median, q3
"""


def _blobs(spark, sf, spread=10):
    key = F.col("p_partkey")
    x = (key % 5) * 18 + F.col("p_size") / spread
    return table(spark, sf, "part").select(
        key.cast("string").alias("code"), "p_name",
        F.when(key % 7 == 0, None).when(key % 11 == 0, "n/a").when(key % 13 == 0, "150").otherwise(x.cast("string")).alias("x"),
        (F.col("p_retailprice") / 1000).cast("string").alias("y"))


def _clusters_by_place(df):
    """(code, cluster): predictions numbered by the mean of ``x`` (k groups, so a bounded broadcast)."""
    means = df.where("prediction is not null").groupBy("prediction").agg(F.avg(F.col("x").try_cast("double")).alias("m"))
    order = means.select("prediction", (F.row_number().over(Window.orderBy("m")) - 1).alias("cluster"))
    return df.select("code", "prediction").join(F.broadcast(order), "prediction", "left").select("code", "cluster")


@register("clusterize_rows", _BLOB_ROWS.replace("from part", "from part where p_partkey % 7 <> 0 and p_partkey % 11 <> 0 and p_partkey % 13 <> 0"))
def q_clusterize_rows(spark, sf):
    """J-B: the cluster of every row of the cleaned mart."""
    mart = jobs.preprocess(_blobs(spark, sf), "code", ["x", "y"])
    return _clusters_by_place(jobs.clusterize(mart, ["x", "y"], k=5, seed=42).predictions)


@register("mart_end_to_end_rows", _BLOB_ROWS)
def q_mart_end_to_end_rows(spark, sf):
    """J-F: the cluster of every row of the enriched wide table."""
    enriched, _ = jobs.mart_end_to_end(_blobs(spark, sf), "code", ["x", "y"], k=5, seed=42)
    return _clusters_by_place(enriched)


@register("mart_box_plots", _BLOB_SPREAD_SQL)
def q_mart_box_plots(spark, sf):
    """J-F's box-plot figures around each of its three filters."""
    return jobs.box_plots(_blobs(spark, sf), "code", ["x"], extra_bounds={"y": 0.95}).select(
        "stage", "column_name", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")


@register("mart_job", _BLOB_ROWS.replace("p_partkey % 13 = 0 then null", "p_partkey % 13 = 0 or p_retailprice / 1000 >= 0.95 then null"))
def q_mart_job(spark, sf):
    """J-F as one job: the cluster of every row of the wide table that it republishes, by the model that it saved."""
    base = shared_dir(spark, "mart_job")
    report = jobs.full_mart(_blobs(spark, sf, 1000), "martlet_job_" + base.rsplit("-", 1)[-1], base, "code", ["x", "y"], extra_bounds={"y": 0.95}, repeatable=8)
    saved = cluster.load_model(report.model_path)
    scored = saved.setPredictionCol("again").transform(cluster.assemble(
        report.enriched.where("prediction is not null").select("code", *[F.col(c).cast("float") for c in ("x", "y")]), ["x", "y"]))
    same = report.enriched.join(scored.select("code", "again"), "code", "left").withColumn(
        "prediction", F.when(F.col("prediction").eqNullSafe(F.col("again")), F.col("prediction")))
    return _clusters_by_place(same)


@register("mart_chain_rows", _BLOB_ROWS)
def q_mart_chain_rows(spark, sf):
    """J-G: the cluster of every row of the wide table that the stage chain republishes."""
    base = shared_dir(spark, "chain_rows")
    tag = base.rsplit("-", 1)[-1]
    wide_name, mart_name = f"martlet_wide_{tag}", f"martlet_mart_{tag}"
    tables.publish(spark, enrich.add_null_column(_blobs(spark, sf), "prediction"), wide_name, f"{base}/{wide_name}")
    cfg = jobs.MartConfig(wide_name, mart_name, base, key="code", features=["x", "y"], k=5, seed=42)
    jobs.run_stages(spark, ["preprocess", "clusterize", "write"], cfg)
    return _clusters_by_place(spark.table(wide_name))


@register("word_count_stream", _ORACLES["word_count"])
def q_word_count_stream(spark, sf):
    """J-E as a stream over the documents file; equals the batch word count."""
    from martlet.streaming.word_count import start_word_count

    # The file stream source lists a directory or a glob; a one-character class
    # makes the single table file a glob that matches exactly that file.
    path = f"{sf.rstrip('/')}/documents.parque[t]"
    base = shared_dir(spark, "wc_stream")
    name = "martlet_wc_" + base.rsplit("-", 1)[-1]
    q = start_word_count(spark, path, table(spark, sf, "documents").schema, "text",
                         name, f"{base}/table", f"{base}/checkpoint", base_path=sf.rstrip("/"))
    q.awaitTermination()
    return tables.read_latest(spark, name)


def flagship(spark, sf):
    """clean -> cluster -> enrich on the dirty part view; the enriched table."""
    enriched, _ = jobs.mart_end_to_end(dirty_part(spark, sf), "code", _FLAG_FEATS, k=5, seed=42)
    return enriched
