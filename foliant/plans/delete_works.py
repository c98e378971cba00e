"""The deletion of works that are none, as one plan over a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import cleanup, integrity, titles
from ..scratch import Scratch

Catalog = dict[str, DataFrame]

#: Tables whose rows go with their work, and the column that names it; files go with their publication.
OF_WORK = (
    ("authorships", "work_id"), ("publications", "work_id"), ("work_subjects", "work_id"), ("funding", "work_id"), ("work_references", "citing_work_id"), ("course_bibliography", "work_id"),
)


def trimmed_titles(works: DataFrame) -> DataFrame:
    """Abstracts without the word for it, titles from their first letter on, three dots as one sign."""
    title = F.when(F.col("title").rlike(r"^[^\p{L}]"), F.trim(text.title_from_letters(F.col("title")))).otherwise(F.col("title"))
    new = {"abstract": text.abstract_without_prefix(F.col("abstract")), "title": text.dots_to_ellipsis(title), "subtitle": text.dots_to_ellipsis(F.col("subtitle"))}
    return works.withColumns({c: v for c, v in new.items() if c in works.columns})


def junk(works: DataFrame) -> DataFrame:
    """id, rule of the works to delete: of P4 to P8 the first that the title meets, else 'review' of P9."""
    kind = F.col("work_type") if "work_type" in works.columns else F.lit(None).cast("string")
    review = titles.cites_a_review(F.col("subtitle"), kind) if "subtitle" in works.columns else F.lit(False)
    rule = F.coalesce(titles.junk_title(F.col("title")), F.when(review, "review"))
    return works.select("id", rule.alias("rule")).where("rule is not null")


def delete_works(c: Catalog) -> tuple[Catalog, DataFrame]:
    """(catalog, id and rule of what was deleted): titles and abstracts trimmed, works that are none deleted with all their rows, then what
    nothing names any more (J7), and publications opened by their venues, licenses or numbers (J8)."""
    scratch = Scratch(c["works"].sparkSession, "deleted")
    works = scratch.write(trimmed_titles(c["works"]), "works")
    gone = scratch.write(junk(works), "gone")
    out = c | {"works": works.join(gone.select("id"), "id", "left_anti").select(*works.columns)}
    for table, column in OF_WORK:
        if table in out:
            out[table] = out[table].join(gone.select(F.col("id").alias(column)), column, "left_anti").select(*out[table].columns)
    out = cleanup.orphans(out)
    if "publications" in out and "venues" in out:
        columns = out["publications"].columns
        out["publications"] = integrity.open_access_from_venues(out["publications"], out["venues"]).select(*columns)
    return out, gone
