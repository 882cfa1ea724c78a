"""Enrichment: look-up joins, performed projects, regions, and merged patents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import words as W
from .retrieval import top_k
from .selection import first_by


def look_up(df: DataFrame, table: DataFrame, key: str, columns: list[str], default: str = "") -> DataFrame:
    """Left join on the normalised id; missing text is the default. The look-up is pruned to its columns and made unique."""
    right = table.select(T.norm_id(F.col(key)).alias("_id"), *columns).dropDuplicates(["_id"])
    out = df.withColumn("_id", T.norm_id(F.col(key))).join(right, "_id", "left").drop("_id")
    text = {f.name for f in table.schema.fields if f.dataType.simpleString() == "string"}
    return out.fillna(default, subset=[c for c in columns if c in text])


def overlap_rank(items: DataFrame, reference: DataFrame, key: str, item: str, ref_text: str, position: str, n: int = 15) -> DataFrame:
    """Items of each key by the tokens they share with the key's reference text, then by position; n at most."""
    shared = F.size(F.array_intersect(T.simple_tokens(F.col(item)), T.simple_tokens(F.col(ref_text))))
    return top_k(items.join(reference, key).withColumn("shared", shared), key, n, F.desc("shared"), F.col(position))


def similar_items(items: DataFrame, key: str, cosine: Column, dedup: str, least: float = 0.5, n: int = 3) -> DataFrame:
    """Of each key the n items nearest to its reference: cosine of at least `least`, one of each dedup value."""
    scored = items.withColumn("cos", cosine).filter(F.col("cos") >= least)
    one = first_by(scored, [key, dedup], F.desc("cos"), F.col("item"))
    return top_k(one, key, n, F.desc("cos"), F.col("item"))


def region_relation(own: Column, other: Column, own_group: Column, other_group: Column, alone: str = W.ALONE) -> Column:
    """'same', 'similar' (another region of one group), 'none', or null where the other region is blank."""
    same = own == other
    similar = (own != alone) & (other != alone) & (own_group == other_group) & (own_group != "")
    return F.when((own == "") | (other == ""), F.lit(None)).when(same, "same").when(F.coalesce(similar, F.lit(False)), "similar").otherwise("none")


def region_group(region: Column) -> Column:
    names = F.create_map(*[F.lit(x) for g, rs in W.REGION_GROUPS.items() for r in rs for x in (r, g)])
    return F.coalesce(F.try_element_at(names, F.trim(region)), F.lit(""))


def merge_patents(p: DataFrame) -> DataFrame:
    """One row for each patent of a project out of its application and registration rows.

    p: project, app_no, reg_no, status ('registered' or 'applied'), name, country, institution, app_date, reg_date, pos.
    A patent is told by its application number, else its registration number, else its row. The base row is the first
    registered, else first applied, else first; institution and application date are of the applied row if there is one.
    """
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    key = F.coalesce(F.concat(F.lit("a"), blank("app_no")), F.concat(F.lit("r"), blank("reg_no")), F.concat(F.lit("p"), F.col("pos").cast("string")))
    row = F.struct("pos", "name", "country", "app_no", "reg_no", "institution", "app_date", "reg_date")
    pick = lambda s: F.min(F.when(F.col("status") == s, row))
    g = p.groupBy("project", key.alias("patent")).agg(pick("registered").alias("r"), pick("applied").alias("a"), F.min(row).alias("f"))
    base = lambda c: F.coalesce(F.col("r"), F.col("a"), F.col("f"))[c]
    applied = lambda c: F.coalesce(F.col("a")[c], base(c))
    reg = F.col("r").isNotNull()
    return g.select(
        "project", "patent", F.when(reg, "registered").otherwise("applied").alias("status"), base("name").alias("name"), base("country").alias("country"), base("app_no").alias("app_no"),
        applied("institution").alias("institution"), applied("app_date").alias("app_date"), F.when(reg, F.col("r")["reg_no"]).alias("reg_no"), F.when(reg, F.col("r")["reg_date"]).alias("reg_date"), base("pos").alias("pos"),
    )


def date_number(c: Column) -> Column:
    """Digits of a date cell as a number; 0 if it is none. Partial dates sort lower."""
    return F.coalesce(F.replace(c, F.lit("."), F.lit("")).try_cast("int"), F.lit(0))


def patent_order() -> list[Column]:
    return [F.desc(F.col("status") == "registered"), F.desc(date_number(F.col("reg_date"))), F.desc(date_number(F.col("app_date"))), F.col("pos")]
