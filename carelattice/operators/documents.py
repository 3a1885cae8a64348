"""Text-level extraction from parsed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.operators.skew import Running, ordered_columns


def _lines(text: Column) -> Column:
    """The lines that hold a "key: value" pair."""
    return F.filter(F.split(text, "\n"), lambda line: line.contains(":"))


def _key(line: Column) -> Column:
    return F.trim(F.substring_index(line, ":", 1))


def _value(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, "^[^:]*:", ""))


def extract_key_values(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document and field, split at the first colon; the last line of a field wins."""
    others = [c for c in docs.columns if c != text]
    lines = docs.select(*others, F.posexplode(_lines(F.col(text))).alias("at", "line"))
    pairs = lines.select(*others, _key(F.col("line")).alias("field"), _value(F.col("line")).alias("value"), "at")
    return pairs.groupBy(*others, "field").agg(F.max_by("value", "at").alias("value"))


def field_value(text: Column, label: str) -> Column:
    """Value of the last line with this label, NULL when there is none."""
    found = F.filter(_lines(text), lambda line: _key(line) == label)
    return _value(F.try_element_at(found, F.lit(-1)))


def money(value: Column) -> Column:
    return F.regexp_replace(value, "[$,]", "").try_cast("decimal(12,2)")


# Field label -> column and type of a claim form.
CLAIM_FIELDS = {
    "Claim ID": ("claim_id", "string"), "Member ID": ("member_id", "string"),
    "Date of Service": ("service_date", "date"), "CPT Code": ("cpt_code", "string"),
    "Billed Amount": ("billed_amount", "money"), "Allowed Amount": ("allowed_amount", "money"),
    "Insurance Paid": ("paid_amount", "money"), "Patient Responsibility": ("patient_amount", "money"),
}


def typed_claim(docs: DataFrame, text: str = "text") -> DataFrame:
    """Claim forms as typed rows; an absent or unreadable field is NULL."""
    out = []
    for label, (name, kind) in CLAIM_FIELDS.items():
        value = field_value(F.col(text), label)
        typed = money(value) if kind == "money" else value.try_cast(kind)
        out.append(typed.alias(name))
    return docs.select(*[c for c in docs.columns if c != text], *out)


def typed_lab_row(value: Column) -> Column:
    """"6.2%" or "118 mg/dL" to a struct of number and unit."""
    number = F.regexp_extract(value, r"^\s*([0-9.]+)", 1).try_cast("double")
    unit = F.nullif(F.trim(F.regexp_replace(value, r"^\s*[0-9.]+", "")), F.lit(""))
    return F.struct(number.alias("number"), unit.alias("unit"))


def pages_from_blocks(blocks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Documents as arrays of pages (page_number, text, blocks) from one row per block."""
    block = F.struct("line_number", "text", F.struct("x0", "y0", "x1", "y1").alias("bbox"))
    pages = blocks.groupBy(doc, "page_number").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    pages = pages.withColumn("text", F.array_join(F.transform("blocks", lambda b: b["text"]), "\n"))
    page = F.struct("page_number", "text", "blocks")
    return pages.groupBy(doc).agg(F.array_sort(F.collect_list(page)).alias("pages"))


def page_stats(docs: DataFrame, pages: str = "pages") -> DataFrame:
    """Pages, characters and blocks per document."""
    total = lambda of: F.aggregate(pages, F.lit(0).cast("long"), lambda n, p: n + of(p))
    return docs.select(
        *[c for c in docs.columns if c != pages],
        F.size(pages).alias("total_pages"),
        total(lambda p: F.length(p["text"])).alias("total_chars"),
        total(lambda p: F.size(p["blocks"])).alias("total_blocks"),
    )


def page_stats_from_blocks(blocks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The same figures straight from block rows, without building the nested documents: a
    document with very many blocks is only counted."""
    pages = blocks.groupBy(doc, "page_number").agg(
        F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("n")
    )
    return pages.groupBy(doc).agg(
        F.count(F.lit(1)).cast("int").alias("total_pages"),
        F.sum(F.col("chars") + F.col("n") - 1).alias("total_chars"),  # one newline between blocks
        F.sum("n").alias("total_blocks"),
    )


def document_context(docs: DataFrame, name: str, pages: str = "pages") -> DataFrame:
    """Header and pages as one text, for documents that fit a row (``context_chunks`` has no such limit)."""
    body = F.array_join(F.transform(pages, lambda p: F.concat(
        F.lit("## Page "), p["page_number"].cast("string"), F.lit("\n"), p["text"], F.lit("\n"))), "\n")
    chars = F.aggregate(pages, F.lit(0).cast("long"), lambda n, p: n + F.length(p["text"]))
    header = F.concat(
        F.lit("# Document: "), F.col(name).cast("string"), F.lit("\nPages: "), F.size(pages).cast("string"),
        F.lit(" | Chars: "), chars.cast("string"), F.lit("\n\n"),
    )
    return docs.select(*[c for c in docs.columns if c != pages], F.concat(header, body).alias("context"))


CHUNK_CHARS = 1_000_000


def context_chunks(blocks: DataFrame, doc: str = "doc_id", limit: int = CHUNK_CHARS) -> DataFrame:
    """The text of ``document_context`` in numbered chunks, straight from block rows: (doc, chunk, first_page, last_page, text).

    The chunks of a document, put together by number, are its context. A chunk starts less than ``limit`` characters after the
    one before it and is longer than ``limit`` by at most one block and its page heading; a document of up to ``limit``
    characters is one chunk. No row, group or task holds a whole document: a block's place comes from running lengths (hot
    documents are cut in ranges, see ``operators/skew.py``), and only the blocks of one chunk meet. Blocks without text count as
    empty, blocks without a page number are left out.
    """
    rows = blocks.filter(F.col("page_number").isNotNull()).select(
        doc, "page_number", "line_number", F.coalesce("text", F.lit("")).alias("text"))
    here = ordered_columns(
        rows, [doc], [F.col(c) for c in ("page_number", "line_number", "text")], running={"_at": Running("rows")},
        framed={"_before": lambda w: F.lag("page_number").over(w), "_after": lambda w: F.lead("page_number").over(w)}, before=1, after=1)
    page, opens = F.col("page_number"), ~F.col("page_number").eqNullSafe(F.col("_before"))
    heading = F.concat(F.when(F.col("_before").isNull(), "").otherwise("\n"), F.lit("## Page "), page.cast("string"), F.lit("\n"))
    closing = F.when(page.eqNullSafe(F.col("_after")), "").otherwise("\n")
    pieces = here.select(doc, "_at", page, F.concat(F.when(opens, heading).otherwise("\n"), "text", closing).alias("text"))
    headers = page_stats_from_blocks(rows, doc).select(
        doc, F.lit(0).cast("long").alias("_at"), F.lit(None).cast(rows.schema["page_number"].dataType).alias("page_number"),
        F.concat(F.lit("# Document: "), F.col(doc).cast("string"), F.lit("\nPages: "), F.col("total_pages").cast("string"),
                 F.lit(" | Chars: "), F.col("total_chars").cast("string"), F.lit("\n\n")).alias("text"))
    placed = ordered_columns(
        headers.unionByName(pieces), [doc], [F.col("_at")],
        running={"_chars": Running("sum", F.length("text").cast("long"), inclusive=False)})
    chunk = placed.groupBy(doc, F.floor(F.col("_chars") / limit).alias("_cut")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "text"))), lambda b: b["text"]), "").alias("text"),
        F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"))
    numbered = Window.partitionBy(doc).orderBy("_cut")  # one row a chunk
    return chunk.select(doc, F.row_number().over(numbered).alias("chunk"), "first_page", "last_page", "text")


CELL = 200.0         # side of a grid cell, in the units of the page
FEW_REGIONS = 10_000  # broadcast up to here
SALTS = 64


def _cells(x0: Column, y0: Column, x1: Column, y1: Column, cell: float) -> Column:
    """The grid cells that a rectangle touches."""
    side = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    return F.flatten(F.transform(side(x0, x1), lambda cx: F.transform(side(y0, y1), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def region_hits(blocks: DataFrame, regions: DataFrame, doc: str = "doc_id", cell: float = CELL) -> DataFrame:
    """Pairs of a block and a region that overlap on their page, each once.

    Both are dealt to the cells of a grid, and only rectangles of one cell meet; the cell that holds the corner where their
    overlap begins reports the pair. Regions that name a document meet the blocks of that document; others meet those of
    all documents: they are broadcast up to ``FEW_REGIONS`` rows, and beyond that repeated over ``SALTS`` shares
    of the documents, so that a page number that all documents have is no hot key."""
    right, bottom = F.col("x") + F.col("width"), F.col("y") + F.col("height")
    some = regions.withColumn("_cell", F.explode(_cells(F.col("x"), F.col("y"), right, bottom, cell)))
    dealt = blocks.withColumn("_cell", F.explode(_cells(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), cell)))
    keys = ["page_number", "_cell"]
    if doc in regions.columns:
        keys.append(doc)
    elif regions.limit(FEW_REGIONS + 1).count() <= FEW_REGIONS:
        some = F.broadcast(some)
    else:
        keys.append("_salt")
        some = some.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64(doc), F.lit(SALTS)).cast("int"))
    overlaps = (F.col("x0") < right) & (F.col("x1") > F.col("x")) & (F.col("y0") < bottom) & (F.col("y1") > F.col("y"))
    corner = F.struct(F.floor(F.greatest(F.least("x0", "x1"), F.least(F.col("x"), right)) / cell).alias("cx"),
                      F.floor(F.greatest(F.least("y0", "y1"), F.least(F.col("y"), bottom)) / cell).alias("cy"))
    return dealt.join(some, keys).where(overlaps & (F.col("_cell") == corner)).drop("_cell", "_salt")


def bbox_extract(blocks: DataFrame, regions: DataFrame, doc: str = "doc_id", cell: float = CELL) -> DataFrame:
    """Text of the blocks that overlap each region of their page, in block order.

    ``regions`` has region, page_number, x, y, width, height and may name a document."""
    found = F.array_sort(F.collect_list(F.struct("line_number", "text")))
    return region_hits(blocks, regions, doc, cell).groupBy(doc, "region").agg(
        F.trim(F.array_join(F.transform(found, lambda b: b["text"]), " ")).alias("text")
    )
