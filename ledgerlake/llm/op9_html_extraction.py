"""Main text of web pages by tree scoring (see ``htmltree``).

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are left out by element and by name; what holds half of the page's text that is no link stays, whatever it
is called, but reader comments go however long they are. Sibling articles that score alike are parts of one. A declaration that is none of HTML's is a comment up to the next ">". Each paragraph passes points for its length and commas to
its ancestors, the nearer the more, discounted by the share of linked text; the best container,
or the article around it, is kept with those siblings that score alike. Text is decoded, white
space within it becomes one space, and blocks are joined by one space in page order.

A null or empty page, or one without text, gives the empty text. Pages are treated one by one,
so repeated rows and ties give repeated results; of containers with equal scores the first one
wins. Nothing is cut: text of any length and elements nested to any depth are read whole. An
empty table gives an empty table. Existing columns named ``text`` and ``n_chars`` are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import prepare, table, texts_of, with_fields
from ledgerlake.llm.htmltree import main_text


def extract(pages: DataFrame, *, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``."""
    prepare(pages.sparkSession)
    kept = [c for c in pages.columns if c.lower() not in (html.lower(), "text", "n_chars")]
    source = pages.select(*kept, F.col(html).alias("text"))

    def convert(batches):
        for batch in batches:
            found = [main_text(page) for page in texts_of(batch.column(len(kept)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=[*kept, "text", "n_chars"])

    return source.mapInArrow(convert, with_fields(source.select(*kept), text="string", n_chars="long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
