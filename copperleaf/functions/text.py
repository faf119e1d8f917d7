"""Long texts cut into blocks for delivery, and the links in a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copperleaf.functions.extract import jtrim

# The size of a block, the least place of a line end to cut at, image markup and links.
BLOCK, LEAST = 2900, 500
IMAGE = r"!\[[^\]]*\]\(([^()\s]+)\)"
LINK = r"(https?://[^\s<>()\"']+)"


#: Characters that are joined to what is left of the ones before and cut, so that work grows with the text and not with its square.
PAGE = 1 << 14


def blocks(text: Column, size: int = BLOCK, least: int = LEAST) -> Column:
    """array<string>: at most ``size`` characters each, cut at the last line end beyond ``least`` if there is one; blank blocks are left out."""
    with_part = lambda parts, part: F.when(part != "", F.concat(parts, F.array(part))).otherwise(parts)

    def cut_one(acc: Column, _: Column) -> Column:
        window = F.substring(acc["rest"], 1, size + 1)
        back = F.instr(F.reverse(window), "\n")
        line_end = F.length(window) - back
        cut = F.when((back > 0) & (line_end > least), line_end).otherwise(size)
        fresh = F.struct(F.substr(acc["rest"], cut + 1).alias("rest"), with_part(acc["parts"], jtrim(F.substr(acc["rest"], F.lit(1), cut))).alias("parts"))
        return F.when(F.length(window) > size, fresh).otherwise(acc)

    def cut_page(acc: Column, page: Column) -> Column:
        start = F.struct(F.concat(acc["rest"], page).alias("rest"), acc["parts"].alias("parts"))
        return F.aggregate(F.sequence(F.lit(1), F.floor((F.length(acc["rest"]) + F.length(page)) / least).cast("int") + 1), start, cut_one)

    none = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("parts"))
    pages = F.regexp_extract_all(jtrim(text), F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))
    return F.aggregate(pages, none, cut_page, lambda acc: with_part(acc["parts"], jtrim(acc["rest"])))


def split_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a block: id, part (from 0), kind (text or image) and body; images are blocks of their own, null and blank texts have none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = F.transform(F.split(text, IMAGE), lambda s: F.transform(blocks(s), lambda b: F.struct(F.lit("text").alias("kind"), b.alias("body"))))
    images = F.transform(F.regexp_extract_all(text, F.lit(IMAGE), F.lit(1)), lambda u: F.array(F.struct(F.lit("image").alias("kind"), u.alias("body"))))
    rows = F.flatten(F.zip_with(texts, images, lambda t, i: F.concat(t, F.coalesce(i, F.array().cast("array<struct<kind:string,body:string>>")))))
    return docs.select(F.col(id_col), F.posexplode(rows).alias("part", "block")).select(id_col, "part", "block.kind", "block.body")


def distinct_urls(text: Column) -> Column:
    """array<string> of the text's links, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(LINK), F.lit(1)))
