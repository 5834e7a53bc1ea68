"""Queries for the parts of the surface that the statistics queries do not pass through:
sources and layers, the page chain, projections, concatenations, text dates, row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions import scalars as S
from skein.operators import cleaners as CL
from skein.operators import joins as J
from skein.operators import opponent as OP
from skein.operators import profile as PR
from skein.operators import reshape as RS
from skein.operators import running as R
from skein.operators import windows as W
from skein.plans import jobs
from skein.plans import queries as Q
from skein.plans import rawdata as RD
from skein.plans.queries import ORACLE, query
from skein.plans.testdata import MATCHES_SQL, long, table
from skein.session import cut_lineage, stored_table
from skein.sources import extract as EX
from skein.sources import io


def positioned(df: DataFrame, name: str = "position") -> DataFrame:
    """Rows of an ordered result with their place in it (from 1): stored once, then numbered
    by partition, so a comparison of values also compares the order."""
    rows = cut_lineage(df.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    before, shift = 0, []
    for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():  # a row per partition
        shift += [F.lit(r["p"]), F.lit(before).cast("bigint")]
        before += r["n"]
    start = F.element_at(F.create_map(*shift), part) if shift else F.lit(0).cast("bigint")
    return rows.withColumn(name, start + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_m")


@query("sorted_positions", f"""
WITH {MATCHES_SQL}
SELECT event_url, fight_url, fighter_url, result,
  row_number() OVER (ORDER BY event_url NULLS LAST, fight_url NULLS LAST, fighter_url NULLS LAST) AS position FROM lg
""")
def sorted_positions(spark, d):
    """O1 with the place of every row in the sorted result."""
    cols = ["event_url", "fight_url", "fighter_url"]
    return positioned(RS.sorted_output(long(spark, d).select(*cols, "result"), cols))


@query("history_positions", """
SELECT o_custkey, strftime(o_orderdate, '%B %d, %Y') AS date, strftime(o_orderdate, '%Y-%m-%d') AS day,
  row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS position, o_orderkey
FROM orders
""")
def history_positions(spark, d):
    """P6 + O3: history rows newest first (equal dates by the tie column), with their places."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("date"), F.lit(0.0).alias("fight_duration_seconds"),
                                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return positioned(PR.history(o, "o_custkey", columns=("date", "day", "o_orderkey"), ties=("o_orderkey",)))


@query("name_list", "SELECT c_name, c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS position FROM customer")
def name_list(spark, d):
    """The entity list sorted by name."""
    return positioned(RS.sorted_output(table(spark, d, "customer").select("c_name", "c_custkey"), ["c_name", "c_custkey"]))


# ---------------------------------------------------------------- sources and layers


def _typed(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        "c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 5 != 0, F.array(F.col("c_mktsegment"), F.lit(None).cast("string"), F.lit('a "b"\\c'))).alias("tags"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") > 0).alias("positive"), "c_acctbal",
    )


_TYPED_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name,
  CASE WHEN c_custkey % 5 <> 0 THEN [c_mktsegment, NULL, 'a "b"\\c'] END AS tags,
  CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal > 0 END AS positive, c_acctbal
FROM customer
"""
_TYPED_SCHEMA = "c_custkey bigint, name string, tags array<string>, positive boolean, c_acctbal double"


@query("json_typed", _TYPED_SQL)
def json_typed(spark, d):
    """S5 + S2: a whole table with arrays, booleans and NULLs as JSON Lines and back."""
    path = Q._scratch_path(spark, "json-typed")
    io.write_json(_typed(spark, d), path)
    return io.read_json(spark, path, _TYPED_SCHEMA, multiline=False)


@query("json_array", _TYPED_SQL)
def json_array(spark, d):
    """Files that each hold one JSON array (here of at most 1000 records) and back."""
    path = Q._scratch_path(spark, "json-array")
    rows = _typed(spark, d).select(F.floor(F.col("c_custkey") / 1000).alias("k"), F.struct("*").alias("r"))
    arrays = rows.groupBy("k").agg(F.to_json(F.collect_list("r"), {"ignoreNullFields": "false"}).alias("value"))
    arrays.write.partitionBy("k").text(path)
    return io.read_json(spark, path, _TYPED_SCHEMA).drop("k")


@query("parquet_typed", _TYPED_SQL)
def parquet_typed(spark, d):
    """S6/S7 + S3: the same table as partitioned Parquet and back."""
    path = Q._scratch_path(spark, "parquet-typed")
    io.write_parquet(_typed(spark, d).withColumn("k", F.col("c_custkey") % 4), path, partition_by=["k"])
    return io.read_parquet(spark, path).drop("k")


@query("clean_layer", ORACLE["clean_results"])
def clean_layer(spark, d):
    """G1 + S4 + S8 + S9: the four raw JSON tables cleaned into a Parquet layer, then loaded."""
    paths = io.layer_paths(Q._scratch_path(spark, "layers"))
    raw = {"events": RD.raw_events, "results": RD.raw_results, "fighters": RD.raw_fighters, "rounds": RD.raw_rounds}
    for name, make in raw.items():
        io.write_json(make(spark, d), paths["raw"][name], "gzip")
    jobs.run_clean(spark, paths, multiline=False)
    return io.load_layer(spark, paths, "clean")["results"]


# ---------------------------------------------------------------- pages


def _chain_pages(spark, d):
    """Index pages of 50 events, an event page and a rounds page per order, a page per
    supplier; every 7th rounds page and every 5th supplier page is broken."""
    o = long(spark, d).groupBy("fight_url").agg(F.sort_array(F.collect_set("fighter_url")).alias("s"))
    k = F.col("fight_url").cast("string")
    link = lambda url, name: F.concat(F.lit('<a class="b-link b-link_style_black" href="'), url, F.lit('">'), name, F.lit("</a>"))
    place = '<td class="b-statistics__table-col b-statistics__table-col_style_big-top-padding">'
    line = F.concat(link(F.concat(F.lit("/event/"), k), F.concat(F.lit("E"), k)), F.lit('<span class="b-statistics__date">May 1, 2020</span>' + place + "X</td>"))
    head = F.lit('<span class="b-statistics__date">next</span>' + place + "next</td>")
    index = o.groupBy(F.floor(F.col("fight_url") / 200).alias("i")).agg(F.concat(head, F.array_join(F.sort_array(F.collect_list(line)), "")).alias("html"))
    index = index.select(F.concat(F.lit("/index/"), F.col("i").cast("string")).alias("url"), "html")
    who = F.array_join(F.transform("s", lambda s: F.concat(F.lit('<a href="/fighter/'), s.cast("string"), F.lit('">x</a>'))), "")
    event = F.concat(F.lit('<tr class="b-fight-details__table-row b-fight-details__table-row__hover js-fight-details-click" data-link="/fight/'), k,
                     F.lit('"><td><a class="b-flag">win</a></td><td>'), who, F.lit("</td><td></td><td></td><td></td><td></td><td>W</td><td>M</td><td>1</td><td>1:00</td></tr>"))
    cells = F.concat(F.lit("<tbody><tr><td>"), who, F.lit("</td><td>"), F.array_join(F.transform("s", lambda s: F.lit("<p>1</p>")), ""), F.lit("</td></tr></tbody>"))
    tab = lambda name: F.concat(F.lit('<section class="b-fight-details__section js-fight-section"><table class="b-fight-details__table"><thead><th>Fighter</th><th>' + name + "</th></thead>"), cells, F.lit("</table></section>"))
    fight = F.when(F.col("fight_url") % 7 != 0, F.concat(F.lit('<a class="b-link" href="/fight/'), k, F.lit('">x</a>'), tab("KD"), tab("Head"))).otherwise(F.lit("<p>gone</p>"))
    s = F.col("s_suppkey")
    person = F.when(s % 5 != 0, F.concat(F.lit('<span class="b-content__title-highlight">'), F.col("s_name"), F.lit("</span>"))).otherwise(F.lit("<p>gone</p>"))
    pages = o.select(F.concat(F.lit("/event/"), k).alias("url"), event.alias("html"))
    pages = pages.unionAll(o.select(F.concat(F.lit("/fight/"), k), fight)).unionAll(index)
    return pages.unionAll(table(spark, d, "supplier").select(F.concat(F.lit("/fighter/"), s.cast("string")), person)), index


@query("page_chain", f"""
WITH {MATCHES_SQL}, k AS (SELECT DISTINCT fight_url FROM lg), s AS (SELECT DISTINCT s_suppkey FROM supplier JOIN lg ON fighter_url = s_suppkey)
SELECT 'events' AS step, '/event/' || fight_url AS url, TRUE AS ok FROM k
UNION ALL SELECT 'results', '/fight/' || fight_url, TRUE FROM k
UNION ALL SELECT 'rounds', '/fight/' || fight_url, fight_url % 7 <> 0 FROM k
UNION ALL SELECT 'fighters', '/fighter/' || s_suppkey, s_suppkey % 5 <> 0 FROM s
""")
def page_chain(spark, d):
    """The four extraction steps in turn, with the pages that fail in the error table."""
    pages, index = _chain_pages(spark, d)
    out = EX.extract_chain(stored_table(pages, "pages"), index=index)  # every step reads them
    key = {"events": "event_url", "results": "fight_url", "rounds": "fight_url", "fighters": "fighter_url"}
    found = [out[step].select(F.lit(step).alias("step"), F.col(c).alias("url"), F.lit(True).alias("ok")).distinct() for step, c in key.items()]
    found.append(out["errors"].select("step", "url", F.lit(False).alias("ok")))
    return RS.union_rows(*found)


@query("page_own_parser", """
SELECT page_id, CAST(length(html) AS BIGINT) AS chars, CAST(len(string_split(html, '<a ')) - 1 AS BIGINT) AS anchors FROM pages
""")
def page_own_parser(spark, d):
    """UD3: a caller's own parser function with its schema."""
    def measure(html):
        return [{"chars": len(html), "anchors": html.count("<a ")}]

    out = EX.extract(table(spark, d, "pages"), measure, keep=("page_id",), schema="chars bigint, anchors bigint")
    return EX.parsed_rows(out).select("page_id", "chars", "anchors")


# ---------------------------------------------------------------- projections, joins, concatenations


@query("projections", """
SELECT c_custkey AS customer, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment,
  round_even(c_acctbal / 7, 2) AS shown, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END, 0) AS filled
FROM customer WHERE c_nationkey = 7
""")
def projections(spark, d):
    """P2, P3, P8, C22, C23, CL0 and G0: rename and drop with absent names, one entity's rows,
    sentinels to NULL, display rounding, zero fill, applied as a cleaner."""
    def cleaner(df):
        return df.withColumns({"segment": S.nullif_blank("c_mktsegment", "BUILDING", ""), "shown": S.display_round(F.col("c_acctbal") / 7, 2),
                               "filled": S.zero_fill(F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")))})

    c = RS.entity_rows(table(spark, d, "customer"), "c_nationkey", 7)
    out = RS.rename(CL.apply_cleaner(c, cleaner), {"c_custkey": "customer", "absent": "x"})
    return RS.drop_existing(out, ["absent", *[x for x in out.columns if x.startswith("c_")]])


@query("suffix_join", """
WITH s AS (SELECT s_nationkey AS k, max(s_name) AS name, min(s_suppkey) AS id FROM supplier GROUP BY s_nationkey)
SELECT c_nationkey AS k, c_name AS name, c_custkey AS id, s.name AS name_opp, s.id AS id_opp
FROM customer LEFT JOIN s ON c_nationkey = s.k
""")
def suffix_join(spark, d):
    """Colliding right-side columns get a suffix."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.max("s_name").alias("name"), F.min("s_suppkey").alias("id"))
    return J.join_on(c, J.suffix_collisions(c, s, ["k"], "_opp"), ["k"], "left")


@query("positional_concat", """
WITH c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS n FROM customer),
o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders)
SELECT c_custkey, o_orderkey FROM c FULL JOIN o ON c.n = o.n
""")
def positional_concat(spark, d):
    """J7 without common columns, U2: two tables side by side, each in its own order."""
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    o = table(spark, d, "orders").select("o_orderkey", (-F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("a"), (-F.col("o_orderkey")).alias("b"))
    return J.natural_join(c, o, order_a=["c_name", "c_custkey"], order_b=["a", "b"]).select("c_custkey", "o_orderkey")


@query("keyed_concat", """
SELECT l_orderkey, l_quantity AS value, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS INTEGER) AS round FROM lineitem
""")
def keyed_concat(spark, d):
    """Elements of a list (an order's lines) with their place, counted from 1."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("ls"))
    listed = lines.select("l_orderkey", F.transform("ls", lambda x: x["l_quantity"]).alias("q"))
    return RS.keyed_concat(listed, "q").select("l_orderkey", "value", F.col("round").cast("int").alias("round"))


# ---------------------------------------------------------------- text dates


@query("latest_text_date", f"""
WITH {RD.RAW_EVENTS_SQL}, p AS (SELECT *, try_strptime(date, '%B %d, %Y') AS t FROM re WHERE location IS NOT NULL)
SELECT location, event_url, strftime(t, '%Y-%m-%d') AS day FROM (
  SELECT *, row_number() OVER (PARTITION BY location ORDER BY t DESC, event_url) AS rn FROM p WHERE t IS NOT NULL) WHERE rn = 1
""")
def latest_text_date(spark, d):
    """W5 + P4 on text dates (``January 5, 2024``); unreadable dates are left out."""
    out = W.latest_per_entity(RD.raw_events(spark, d), "location", "date", ties=["event_url"], date_format="MMMM d, yyyy")
    return out.select("location", "event_url", F.date_format("date", "yyyy-MM-dd").alias("day"))


@query("unparsed_dates", f"WITH {RD.RAW_EVENTS_SQL} SELECT event_url, date FROM re WHERE date IS NOT NULL AND try_strptime(date, '%B %d, %Y') IS NULL")
def unparsed_dates(spark, d):
    """The rows that P4 leaves out, for inspection."""
    return W.unparsed_dates(RD.raw_events(spark, d).select("event_url", "date"), "date", "MMMM d, yyyy")


@query("bonus_totals", f"""
WITH ct AS ({ORACLE["career_table"]})
SELECT fighter_url, total_title_fight, total_perf_bonus, total_fight_of_the_night FROM (
  SELECT *, row_number() OVER (PARTITION BY fighter_url ORDER BY date DESC, fight_url) AS rn FROM ct
  WHERE date IS NOT NULL AND fighter_url IS NOT NULL) WHERE rn = 1
""")
def bonus_totals(spark, d):
    """title and bonus totals of every entity's latest row."""
    ct = Q.career_table(spark, d).withColumn("date", F.to_timestamp("date"))
    out = W.latest_per_entity(ct, "fighter_url", "date", ties=["fight_url"])
    return out.select("fighter_url", "total_title_fight", "total_perf_bonus", "total_fight_of_the_night")


# ---------------------------------------------------------------- W1 with many labels


@query("category_maps", """
WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS n FROM lineitem),
c AS (SELECT a.l_suppkey, a.n, b.l_partkey AS part, count(*) AS total FROM r a JOIN r b ON a.l_suppkey = b.l_suppkey AND b.n <= a.n GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, n, CAST(count(*) AS INTEGER) AS labels,
  string_agg(part || ':' || total, ',' ORDER BY part) AS totals
FROM r JOIN c USING (l_suppkey, n) GROUP BY ALL
""")
def category_maps(spark, d):
    """W1 for thousands of labels: per line item, how often each part has come from its supplier
    so far."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    out = W.category_maps(W.row_count(li, "l_suppkey", order, "n"), "l_partkey", "l_suppkey", order, text=True, keep=["l_orderkey", "l_linenumber", "l_partkey", "n"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "n", F.col("totals_size").alias("labels"), "totals")


# ---------------------------------------------------------------- C10: form of the first value

_MIXED_SQL = """
x AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 7 = 1 THEN '' WHEN o_orderkey % 3 = 2 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE strftime(o_orderdate, '%B %-d, %Y') END AS text FROM orders),
f AS (SELECT CASE WHEN text LIKE '____-__-__' THEN 'iso' WHEN text LIKE '%/%' THEN 'slash' ELSE 'words' END AS form FROM x WHERE text <> '' ORDER BY o_orderkey LIMIT 1),
p AS (SELECT o_orderkey, text, CASE WHEN text <> '' AND CASE WHEN text LIKE '____-__-__' THEN 'iso' WHEN text LIKE '%/%' THEN 'slash' ELSE 'words' END = (SELECT form FROM f)
        THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM x)
"""


def _mixed_dates(spark, d):
    k, t = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(k % 7 == 1, "").when(k % 3 == 2, F.date_format(t, "yyyy-MM-dd")).when(k % 3 == 0, F.date_format(t, "M/d/yyyy"))
            .otherwise(F.date_format(t, "MMMM d, yyyy")))
    mixed = table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return W.dates_like_first(mixed, "text", ["o_orderkey"], "read").select("o_orderkey", "text", F.date_format("read", "yyyy-MM-dd").alias("day"))


@query("first_format_dates", f"WITH {_MIXED_SQL} SELECT * FROM p")
def first_format_dates(spark, d):
    """A text column of mixed date forms, read by the form of its first value."""
    return _mixed_dates(spark, d)


@query("first_format_unread", f"WITH {_MIXED_SQL} SELECT o_orderkey, text FROM p WHERE text <> '' AND day IS NULL")
def first_format_unread(spark, d):
    """The rows whose dates have another form than the first."""
    return _mixed_dates(spark, d).where("text <> '' AND day IS NULL").select("o_orderkey", "text")


# ---------------------------------------------------------------- J8 with a hot match


@query("opponent_hot_match", """
WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS cnt FROM orders)
SELECT a.o_orderstatus, a.o_orderkey, b.o_orderkey AS opp FROM r a JOIN r b ON a.o_orderstatus = b.o_orderstatus AND b.rn = a.cnt + 1 - a.rn
""")
def opponent_hot_match(spark, d):
    """J8 where a match holds half of all rows: the mirror of every order within its status."""
    o = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_orderdate")
    return OP.opponent_by_reversal(o, "o_orderstatus", "o_orderkey", ["o_orderdate", "o_orderkey"], "opp").select("o_orderstatus", "o_orderkey", "opp")


# ---------------------------------------------------------------- W2: sums of any magnitude


@query("exact_totals", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_quantity) AS DOUBLE) AS large, CAST(sum(floor(l_quantity)) OVER w AS DOUBLE) AS small
FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def exact_totals(spark, d):
    """W2 on doubles near 1e30 and near 1e-30 in one running total: every line item adds a large
    value, a small one and the large one's opposite. What is left after the third is the running
    sum of the small ones, which ordinary double sums lose."""
    li = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    q, up, down = F.floor("l_quantity").cast("double"), F.lit(2.0**100), F.lit(2.0**-100)
    rows = li.select("*", F.posexplode(F.array(q * up, q * down, -q * up)).alias("place", "x"))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "place"]
    out = W.numeric_totals(rows, "x", "l_suppkey", order)
    per_line = R.running(out, "l_suppkey", order, [R.lag("with_large", "total_x", 2)]).where("place = 2")
    return per_line.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("with_large") * down).alias("large"), (F.col("total_x") * up).alias("small"))


# ---------------------------------------------------------------- S4 -> G3 -> S7


@query("transform_layer", ORACLE["results_stats_full"])
def transform_layer(spark, d):
    """The clean layer is written, transformed and written by event year; then one year is
    spoilt, transformed again and replaced, and the whole layer read back."""
    paths = io.layer_paths(Q._scratch_path(spark, "layers"))
    clean = {
        "results": CL.clean_results(RD.raw_results(spark, d)), "events": CL.clean_events(RD.raw_events(spark, d)).select("event_url", "date"),
        "fighters": CL.clean_fighters(RD.raw_fighters(spark, d)), "rounds": CL.clean_rounds(RD.raw_rounds(spark, d))}
    for name, df in clean.items():
        io.write_parquet(df, paths["clean"][name])
    path = jobs.run_transform(spark, paths, tables=("results",))["results"]
    year = F.year("event_date") == 1995
    io.write_years(io.read_parquet(spark, path).where(year).drop("event_year").withColumn("result", F.lit("spoilt")), path)
    jobs.run_transform(spark, paths, years=[1995], tables=("results",))
    return Q.results_columns(io.read_parquet(spark, path))
