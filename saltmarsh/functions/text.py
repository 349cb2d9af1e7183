"""Text, tag, HTML and JSON Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"


def text_normalize(x: Column) -> Column:
    """Lower case, punctuation out, no-break spaces to plain spaces."""
    no_break = F.regexp_replace(F.lower(x), "\u00a0", " ")
    return F.regexp_replace(no_break, r"[^\p{L}\p{N}_\s]", "")


def words(x: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(F.lower(x), F.lit(f"({pattern})"), F.lit(1))


def tokens(x: Column) -> Column:
    """Words and single runs of punctuation."""
    return F.regexp_extract_all(F.lower(x), F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+)"), F.lit(1))


def tag_cleanup(x: Column) -> Column:
    """``<a><b>`` to ``a b``."""
    return F.rtrim(F.regexp_replace(F.regexp_replace(x, "<", ""), ">", " "))


def items(x: Column, separator: str = ",") -> Column:
    """Trimmed, non-null list from a delimited string."""
    return F.transform(F.split(x, F.lit(f"[{separator}]")), lambda s: F.trim(s))


def split_count(x: Column, separator: str = ",") -> Column:
    return F.size(F.split(F.trim(x), F.lit(f"[{separator}]")))


def has_any(tags: Column, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(tags, F.array(*[F.lit(w) for w in wanted]))


def list_contains_score(tags: Column, bad: Sequence[str]) -> Column:
    """1 if any tag is bad, else 5; null stays null."""
    return F.when(tags.isNull(), F.lit(None)).when(has_any(tags, bad), 1).otherwise(5)


def tiered_tag_score(tags: Column, tiers: Mapping[int, Sequence[str]]) -> Column:
    """Score of the first tier with a matching tag, highest first, else 1."""
    out = None
    for score in sorted(tiers, reverse=True):
        hit = has_any(tags, tiers[score])
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return F.when(tags.isNull(), F.lit(None)).otherwise(out.otherwise(1))


def html_to_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags out, common entities decoded, spaces collapsed."""
    x = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    x = F.regexp_replace(x, r"(?is)<style[^>]*>.*?</style>", " ")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(x, r"[ \t\r\n]+", " "))


def concat_title_body(title: Column, body: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), body)


def parse_list_string(x: Column, n: int) -> list[Column]:
    """The first ``n`` numbers of ``"[a, b, c]"`` as doubles."""
    parts = F.split(F.substring(x, F.lit(2), F.length(x) - 2), F.lit(", ?"))
    return [F.get(parts, F.lit(i)).cast("double") for i in range(n)]


def path_part(url: Column, index: int) -> Column:
    """Path segment ``index`` (1-based, from the end if negative) without query or fragment."""
    clean = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-z]+://", "")
    return F.try_element_at(F.split(clean, "/"), F.lit(index))
