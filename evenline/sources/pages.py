"""Title, heading and body of raw web pages, with built-in regex functions
(the pattern set is portable: no lookaround, no backreferences).

Fixed values:
  title    first <title>...</title>
  heading  first <h1 ...>...</h1>
  body     every <p ...>...</p>, joined by one space
  tags     <...> become one space; runs of space, tab, CR, LF become one space
  entities &lt; &gt; &quot; &#39; &nbsp; then &amp; (decoded last)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenline.functions.text import concat_fields

TITLE_PATTERN = r"(?is)<title[^>]*>(.*?)</title>"
HEADING_PATTERN = r"(?is)<h1[^>]*>(.*?)</h1>"
PARAGRAPH_PATTERN = r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"
TAG_PATTERN = r"<[^>]*>"
SPACE_PATTERN = "[ \t\r\n]+"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def clean_fragment(c: Column) -> Column:
    x = F.regexp_replace(c, F.lit(TAG_PATTERN), F.lit(" "))
    for ent, ch in ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    x = F.trim(F.regexp_replace(x, F.lit(SPACE_PATTERN), F.lit(" ")))
    return F.nullif(x, F.lit(""))


def _first(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def page_fields(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Adds ``title, heading, body`` (null when absent or blank)."""
    h = F.col(html_col)
    body = F.array_join(F.regexp_extract_all(h, F.lit(PARAGRAPH_PATTERN), 1), " ")
    return (pages
            .withColumn("title", clean_fragment(_first(h, TITLE_PATTERN)))
            .withColumn("heading", clean_fragment(_first(h, HEADING_PATTERN)))
            .withColumn("body", clean_fragment(body)))


def page_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``title + heading + body`` as one model input (A3 over pages)."""
    return page_fields(pages, html_col).withColumn("text", concat_fields("title", "heading", "body"))
