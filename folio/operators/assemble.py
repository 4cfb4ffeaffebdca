"""Document assembly from extracted pieces: roll-ups, reading order, captions, styling,
tables and chart text.

Inputs are flat "raw element" tables with scope columns (job_id, page, block, line,
span, pos) so every rule is a group-by, a window or a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.operators.ranking import scan
from folio.session import cut_lineage

# Roll-up depths (finest first) and the chart JSON keys, in output order.
DEPTH_KEYS = {
    "span": ["page", "block", "line", "span"],
    "line": ["page", "block", "line"],
    "block": ["page", "block"],
    "page": ["page"],
    "document": [],
}
CHART_KEYS = ["caption", "info_deplot", "x_title", "xlabel", "y_title", "ylabel", "legend_label",
              "legend_title", "mark_label", "value_label", "other"]
ROWS_TASK = 250_000  # rows that a task sorts at a time, or those of its largest group
# characters escaped by the slide renderer: backslash * ` ! _ { } [ ] ( ) # and the range "+-."
_ESCAPE_CLASS = "([\\\\*`!_{}\\[\\]()#+,\\-.])"


def _sorted_join(col_text: str, sep: str, order_cols) -> Column:
    item = F.struct(*[F.col(c) for c in order_cols], F.col(col_text).alias("_t"))
    return F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_t"]), sep)


def rollup_text(df: DataFrame, depth: str = "document", sep: str = " ", keep_empty: bool = False,
                order_cols=("pos",)) -> DataFrame:
    """Accumulate text in reading order and cut one row per unit of ``depth``
    (span/line/block/page/document); pieces joined with ``sep`` (" " for PDF and DOCX,
    "" for slides). Empty results are dropped unless ``keep_empty``.

    One aggregation keyed by (job, depth keys); a unit's pieces meet in one task, which
    is what the unit's output row holds anyway."""
    if depth not in DEPTH_KEYS:
        raise ValueError(f"depth must be one of {list(DEPTH_KEYS)}")
    keys = ["job_id", *DEPTH_KEYS[depth]]
    out = df.groupBy(*keys).agg(_sorted_join("text", sep, list(order_cols)).alias("text"),
                                F.count("*").alias("n_pieces"))
    if not keep_empty:
        out = out.where(F.length("text") > 0)
    return out


def order_shapes(df: DataFrame, scope=("job_id", "page"), top: str = "top", left: str = "left") -> DataFrame:
    """Reading order by (top, left), ties by pos: adds ``reading_order`` (1-based).

    A page's shapes are counted along slices (:mod:`folio.operators.ranking`), however many it has."""
    return scan(df, scope, [top, left, "pos"], sums={"reading_order": F.lit(1).cast("long")})


def nearby_pointers(df: DataFrame, scope=("job_id", "page"), order_cols=("top", "left", "pos")) -> DataFrame:
    """The blocks of each page as one ordered list of texts, and how far into it every row reaches.

    Adds ``text_order``, a text's 1-based place in the list (null for rows without text), ``nearby_count``,
    the texts at or before the row in reading order, and ``nearby_last``, the last of them: a row's nearby
    texts are the first ``nearby_count`` of its page. One row in, one row out."""
    has_text = F.coalesce(F.length("text") > 0, F.lit(False))
    out = scan(df, scope, order_cols, sums={"nearby_count": has_text.cast("long")}, lasts={"nearby_last": F.when(has_text, F.col("text"))})
    return out.withColumn("text_order", F.when(has_text, F.col("nearby_count")))


NEARBY_CHUNK = 256


def nearby_blocks(df: DataFrame, scope=("job_id", "page"), order_cols=("top", "left", "pos"),
                  is_image_col: str = "is_image") -> DataFrame:
    """For every image row: the text blocks at or before it in reading order (its own
    text included when it has some), as ``nearby_text`` (array) and ``nearby_bbox``.

    Images point into their page's list (:func:`nearby_pointers`), which is kept in rows of
    NEARBY_CHUNK texts, and take the chunks they reach. The arrays repeat a page's texts for each of its
    images; where that is too much, the pointers say the same in one row each."""
    scope = list(scope)
    placed = nearby_pointers(df.withColumn("_image", F.monotonically_increasing_id()), scope, order_cols)
    placed = cut_lineage(placed, "table")  # numbers of rows stay what they are
    chunk = F.floor((F.col("text_order") - 1) / NEARBY_CHUNK)
    item = F.struct("text_order", F.col("text").alias("t"), F.array("x1", "y1", "x2", "y2").alias("b"))
    lists = placed.where(F.col("text_order").isNotNull()).groupBy(*scope, chunk.alias("_chunk")).agg(F.array_sort(F.collect_list(item)).alias("_list"))
    lists = lists.select(*[F.col(c).alias(f"_of_{c}") for c in scope], "_chunk", "_list")
    is_image = F.coalesce(F.col(is_image_col), F.lit(False))
    images = placed.where(is_image & (F.col("nearby_count") > 0)).select(
        *scope, "_image", "nearby_count", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("nearby_count") - 1) / NEARBY_CHUNK))).alias("_chunk"))
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in scope]
    reached = images.join(lists.withColumnRenamed("_chunk", "_at"), [*same, F.col("_chunk") == F.col("_at")]).withColumn(
        "_list", F.filter("_list", lambda x: x["text_order"] <= F.col("nearby_count")))
    found = reached.groupBy(F.col("_image").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("_chunk", "_list"))).alias("_all"))
    found = found.select("_row", F.flatten(F.transform("_all", lambda x: x["_list"])).alias("_l"))
    out = placed.join(found, F.col("_image") == F.col("_row"), "left")
    filled = F.when(is_image, F.coalesce("_l", F.array().cast(found.schema["_l"].dataType)))
    return (out.withColumn("_l", filled)
               .withColumn("nearby_text", F.transform("_l", lambda x: x["t"]))
               .withColumn("nearby_bbox", F.transform("_l", lambda x: x["b"]))
               .select(*df.columns, "nearby_text", "nearby_bbox"))


def caption_from_next_block(df: DataFrame, scope=("job_id",), kind_col: str = "kind") -> DataFrame:
    """Caption of an image = text of the next paragraph after it in ``pos`` order, "" at
    the end of the document.

    Walked backwards, the next paragraph is the last one seen: a scan along slices that carries it from
    one to the next, so a long document is not one task's."""
    para_text = F.when(F.col(kind_col) == "paragraph", F.col("text"))
    out = scan(df, scope, [F.col("pos").desc()], lasts={"_next": para_text})
    return out.withColumn("caption", F.when(F.col(kind_col) == "image", F.coalesce("_next", F.lit("")))).drop("_next")


def escape_markdown(c: Column) -> Column:
    """Backslash-escape markdown characters, then every ``<...>`` tag."""
    step1 = F.regexp_replace(c, _ESCAPE_CLASS, "\\\\$1")
    return F.regexp_replace(step1, "(<[^>]+>)", "\\\\$1")


def format_text(text: Column, bold: Column, italic: Column, underline: Column) -> Column:
    """Wrap the non-blank core of ``text`` with ``**``, ``*``, ``<u>``; leading and
    trailing whitespace stays outside; blank text is returned as is."""
    pre = F.regexp_extract(text, "^(?s)(\\s*)", 1)
    post = F.regexp_extract(text, "(?s)\\S(\\s*)$", 1)
    core = F.substring(text, F.length(pre) + 1, F.length(text) - F.length(pre) - F.length(post))
    core = F.when(F.coalesce(bold, F.lit(False)), F.concat(F.lit("**"), core, F.lit("**"))).otherwise(core)
    core = F.when(F.coalesce(italic, F.lit(False)), F.concat(F.lit("*"), core, F.lit("*"))).otherwise(core)
    core = F.when(F.coalesce(underline, F.lit(False)), F.concat(F.lit("<u>"), core, F.lit("</u>"))).otherwise(core)
    return F.when(text.rlike("(?U)\\S"), F.concat(pre, core, post)).otherwise(text)


def render_markdown_text(df: DataFrame, single_style: bool = True, escape: bool = True) -> DataFrame:
    """Runs table (text, bold, italic, underline [, url]) -> ``markdown``.

    ``single_style`` (slides): italic wins, else bold, else underline; otherwise (word
    processing) all flags apply. A run with a URL becomes ``[text](url)``, styled as a whole. A run with
    ``in_list`` gets ``* `` before it, two blanks further in for each ``level``."""
    t = escape_markdown(F.col("text")) if escape else F.col("text")
    b, i, u = F.col("bold"), F.col("italic"), F.col("underline")
    if single_style:
        i2 = F.coalesce(i, F.lit(False))
        b = ~i2 & F.coalesce(b, F.lit(False))
        u = ~i2 & ~b & F.coalesce(u, F.lit(False))
        i = i2
    if "url" in df.columns:
        t = F.when(F.col("url").isNotNull(), F.concat(F.lit("["), t, F.lit("]("), F.col("url"), F.lit(")"))).otherwise(t)
    out = format_text(t, b, i, u)
    if "in_list" in df.columns:
        level = F.coalesce(F.col("level"), F.lit(0)).cast("int") if "level" in df.columns else F.lit(0)
        out = F.when(F.coalesce("in_list", F.lit(False)), F.concat(F.repeat(F.lit("  "), level), F.lit("* "), out)).otherwise(out)
    return df.withColumn("markdown", out)


def merge_styled_runs(df: DataFrame, scope=("job_id", "paragraph")) -> DataFrame:
    """Adjacent runs with the same (bold, italic, underline) merge; blank runs never
    change the current style, and leading ones belong to the first group. Gaps-and-islands: lag + running sum over a window, then one
    aggregation per island; output: scope, run_group, text, bold, italic, underline."""
    blank = ~F.coalesce(F.col("text").rlike("(?U)\\S"), F.lit(False))
    style = F.when(~blank, F.struct(F.coalesce(F.col("bold"), F.lit(False)).alias("bold"),
                                    F.coalesce(F.col("italic"), F.lit(False)).alias("italic"),
                                    F.coalesce(F.col("underline"), F.lit(False)).alias("underline")))
    w = Window.partitionBy(*scope).orderBy("pos")
    filled = df.withColumn("_s", style).withColumn(
        "_eff", F.last("_s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    before = F.lag("_eff").over(w)
    chg = (before.isNotNull() & ~before.eqNullSafe(F.col("_eff"))).cast("int")
    g = filled.withColumn("_chg", chg).withColumn("run_group", F.sum("_chg").over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return (g.groupBy(*scope, "run_group").agg(
        _sorted_join("text", "", ["pos"]).alias("text"),
        F.max_by(F.col("_eff"), F.col("pos")).alias("_st"), F.min("pos").alias("pos"))
        .select(*scope, "run_group", "pos", "text",
                F.coalesce(F.col("_st.bold"), F.lit(False)).alias("bold"),
                F.coalesce(F.col("_st.italic"), F.lit(False)).alias("italic"),
                F.coalesce(F.col("_st.underline"), F.lit(False)).alias("underline")))


def apply_text_style(df: DataFrame, style_col: str = "style", text_col: str = "text",
                     level_col: str | None = "level") -> DataFrame:
    """Heading n -> ``#``*n; List* -> ``- ``; Title / Subtitle underlined with ``=`` / ``-``;
    then one tab per indent level."""
    s, t = F.col(style_col), F.col(text_col)
    n = F.regexp_extract(s, "^Heading ([1-9])$", 1)
    styled = (F.when(n != "", F.concat(F.repeat(F.lit("#"), n.cast("int")), F.lit(" "), t))
              .when(s.startswith("List"), F.concat(F.lit("- "), t))
              .when(s == "Title", F.concat(t, F.lit("\n"), F.repeat(F.lit("="), F.length(t))))
              .when(s == "Subtitle", F.concat(t, F.lit("\n"), F.repeat(F.lit("-"), F.length(t))))
              .otherwise(t))
    lvl = F.coalesce(F.col(level_col), F.lit(0)) if level_col and level_col in df.columns else F.lit(0)
    return df.withColumn("styled", F.concat(F.repeat(F.lit("\t"), lvl), styled))


def spread(df: DataFrame, keys) -> DataFrame:
    """``df`` in as many partitions by ``keys`` as leave about ROWS_TASK rows to each, where the session's number of
    shuffle partitions leaves more; counts ``df``."""
    n = -(-df.count() // ROWS_TASK)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def render_table(cells: DataFrame, fmt: str = "markdown", scope=("job_id", "table_id"), tag: str = "<table {}>") -> DataFrame:
    """Cells (scope, row, col, text; row 0 = header) -> one rendered table per scope.

    markdown: ``| a | b |`` rows under a ``|---|---|`` rule; markdown_light: runs of
    whitespace and of dashes collapsed; csv: header with a leading empty index column,
    data rows prefixed with their 0-based index, fields quoted when needed; tag: ``tag`` with the
    table's number in its document, from 1, documents being told apart by all of ``scope`` but its last.

    Cells meet by table in shares of about ROWS_TASK (the cells are counted), rows and tables in the same tasks."""
    scope = list(scope)
    if fmt == "tag":
        tables = cells.select(*scope).distinct()
        numbered = scan(tables, scope[:-1], [scope[-1]], sums={"_n": F.lit(1).cast("long")})
        return numbered.select(*scope, F.replace(F.lit(tag), F.lit("{}"), F.col("_n").cast("string")).alias("table"))
    cells = cells.withColumn("text", F.coalesce("text", F.lit("")))  # an empty cell keeps its column
    if fmt not in ("markdown", "markdown_light", "csv"):
        raise ValueError("fmt must be markdown, markdown_light, csv or tag")
    if scope:
        cells = spread(cells, scope)
    if fmt == "csv":
        q = F.col("text")
        cell = F.when(q.rlike('[,"\\n\\r]'), F.concat(F.lit('"'), F.replace(q, F.lit('"'), F.lit('""')), F.lit('"'))) \
            .otherwise(q)
        rows = cells.withColumn("_c", cell).groupBy(*scope, "row").agg(_sorted_join("_c", ",", ["col"]).alias("_r"))
        rows = rows.withColumn("_r", F.when(F.col("row") == 0, F.concat(F.lit(","), "_r"))
                               .otherwise(F.concat((F.col("row") - 1).cast("string"), F.lit(","), "_r")))
        out = rows.groupBy(*scope).agg(F.concat(_sorted_join("_r", "\n", ["row"]), F.lit("\n")).alias("table"))
        return out
    rows = cells.groupBy(*scope, "row").agg(_sorted_join("text", " | ", ["col"]).alias("_r"),
                                            F.count("*").alias("_n"))
    rows = rows.withColumn("_r", F.concat(F.lit("| "), "_r", F.lit(" |")))
    line = F.struct(F.col("row").cast("double").alias("row"), "_r")
    rule = F.struct(F.lit(0.5).alias("row"), F.concat(
        F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), F.col("_n").cast("int")), "|"), F.lit("|")).alias("_r"))
    lines = rows.select(*scope, F.when(F.col("row") == 0, F.array(line, rule)).otherwise(F.array(line)).alias("_l"))
    in_order = F.array_sort(F.flatten(F.collect_list("_l")))
    out = lines.groupBy(*scope).agg(F.array_join(F.transform(in_order, lambda x: x["_r"]), "\n").alias("table"))
    if fmt == "markdown_light":
        out = out.withColumn("table", F.regexp_replace(F.regexp_replace("table", "\\s{2,}", " "), "-{2,}", "-"))
    return out


def join_chart_text(cached, model) -> Column:
    """Chart text: title, then " " + model text, then " " + each further key of the
    cached JSON; text that is not JSON is used as is (plus the model text); with no
    cached text only " " + model text."""
    c = F.col(cached) if isinstance(cached, str) else cached
    m = F.col(model) if isinstance(model, str) else model
    schema = "struct<" + ",".join(f"{k}:string" for k in ["chart_title", *CHART_KEYS]) + ">"
    js = F.from_json(c, schema)
    is_json = c.rlike("^\\s*\\{") & F.get_json_object(c, "$").isNotNull()
    parts = [F.coalesce(js["chart_title"], F.lit("")),
             F.when(m.isNotNull(), F.concat(F.lit(" "), m)).otherwise(F.lit(""))]
    parts += [F.concat(F.lit(" "), F.coalesce(js[k], F.lit(""))) for k in CHART_KEYS]
    from_json_text = F.concat(*parts)
    raw = F.concat(c, F.when(m.isNotNull(), F.concat(F.lit(" "), m)).otherwise(F.lit("")))
    only_model = F.when(m.isNotNull(), F.concat(F.lit(" "), m)).otherwise(F.lit(""))
    return F.when(c.isNull(), only_model).when(is_json, from_json_text).otherwise(raw)
