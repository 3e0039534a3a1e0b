"""URL expressions. All are native columns: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Optional scheme, then "//", then the authority up to the path, query or fragment.
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_BEFORE_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?"

# The URL retrieval patterns. The dots are unescaped and "(i?)" is
# an optional letter, not a flag; both are part of the expected results.
HUGGINGFACE = r"(huggingface.co)"
OPENAI = r"(openai.com)"
PDF = r"(?i).pdf"
CLOUD = r"(?i)\b(aws|amazon|case study)"
ARXIV = r"(i?)(arxiv)"


def url_domain(url: Column) -> Column:
    """Authority part of a URL, user info, port and case kept; '' when it has none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def url_hostname(url: Column) -> Column:
    """Lower-cased host without user info and port; NULL when the URL has none."""
    host_port = F.regexp_replace(url_domain(url), r"^.*@", "")
    bracketed = F.regexp_extract(host_port, r"^\[([^\]]*)", 1)
    plain = F.split_part(host_port, F.lit(":"), F.lit(1))
    return F.nullif(F.lower(F.when(F.startswith(host_port, F.lit("[")), bracketed).otherwise(plain)), F.lit(""))


def url_path(url: Column) -> Column:
    """Path of a URL, without scheme, authority, query and fragment."""
    return F.regexp_extract(F.regexp_replace(url, _BEFORE_PATH, ""), r"^([^?#]*)", 1)


def crawl_year(crawl_url: Column) -> Column:
    """Year of a crawl index URL such as ``.../CC-MAIN-2024-33/...``: last but one '-' field."""
    return F.try_element_at(F.split(crawl_url, "-"), F.lit(-2))


def local_path(crawl_path: Column, data_dir: str) -> Column:
    """Where an archive lies after download: data folder + file name minus its last extension.

    A name without a dot leaves nothing but the folder, as the extension is all there is.
    """
    name = F.element_at(F.split(crawl_path, "/"), -1)
    return F.concat(F.lit(data_dir), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1))
