"""Object-key rules as Column expressions: base name, page number,
extension, content type, routing, MIME check and destination keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference rules for equal results.
PAGE_NAME_PATTERN = r"^(.+?)[_-](\d+)\.(.+)$"        # base, page number, extension
INCOMING_PREFIX = "incoming/"
DOCUMENT_SUFFIXES = [".jpg", ".jpeg", ".png", ".pdf"]  # routed to documents (case-sensitive)
ARCHIVE_SUFFIX = ".zip"                                 # routed to archives
SUPPORTED_MIME_TYPES = ["image/jpeg", "image/jpg", "image/png", "image/tiff", "image/tif"]
CONTENT_TYPES = {
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".pdf": "application/pdf",
    ".txt": "text/plain",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
# ---------------------------------------------------------------------------

# splitext: the last dot-segment is the extension, leading dots are part of the name
_SPLITEXT = r"^(\.*[^.].*)(\.[^.]*)$"


def basename(key: Column) -> Column:
    return F.element_at(F.split(key, "/", -1), -1)


def strip_extension(name: Column) -> Column:
    stem = F.regexp_extract(name, _SPLITEXT, 1)
    return F.when(stem != "", stem).otherwise(name)


def extension(name: Column) -> Column:
    """The extension with its dot ('' when there is none), like ``splitext``."""
    return F.regexp_extract(name, _SPLITEXT, 2)


def base_name(key: Column) -> Column:
    """Document base name: ``name-3.jpg``/``name_3.jpg`` -> ``name``; otherwise the
    file name without its extension."""
    b = basename(key)
    grp = F.regexp_extract(b, "(?U)" + PAGE_NAME_PATTERN, 1)
    return F.when(grp != "", grp).otherwise(strip_extension(b))


def page_number(key: Column) -> Column:
    """Page number written in the file name, null when the name has none."""
    b = basename(key)
    num = F.regexp_extract(b, "(?U)" + PAGE_NAME_PATTERN, 2)
    return F.when(num != "", num.try_cast("bigint"))


def content_type_for(ext: Column) -> Column:
    m = F.create_map(*[x for k, v in CONTENT_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[F.lower(ext)], F.lit(DEFAULT_CONTENT_TYPE))


def route(key: Column) -> Column:
    """'document', 'archive' or null, by case-sensitive suffix under incoming/.

    Each suffix is a dot plus a dot-free word, so "ends with it" is the same as
    "the text after the last dot is that word"; one lookup on that segment
    replaces a test per suffix.
    """
    routes = {s[1:]: "document" for s in DOCUMENT_SUFFIXES}
    routes[ARCHIVE_SUFFIX[1:]] = "archive"
    m = F.create_map(*[x for k, v in routes.items() for x in (F.lit(k), F.lit(v))])
    last = F.substring_index(key, ".", -1)
    return F.when(key.startswith(INCOMING_PREFIX) & (F.instr(key, ".") > 0), m[last])


def mime_supported(content_type: Column) -> Column:
    """MIME allow-list; a missing type is rejected."""
    return F.coalesce(content_type.isin(SUPPORTED_MIME_TYPES), F.lit(False))


def decode_key(key: Column) -> Column:
    """URL-decoded object key ('+' is a space); undecodable keys stay as they are."""
    return F.coalesce(F.try_url_decode(key), key)


def in_listing_folder(key: Column, prefix: str = INCOMING_PREFIX) -> Column:
    """One folder level under ``prefix``, the folder marker itself excluded."""
    rest = F.substring(key, len(prefix) + 1, 1 << 30)
    return key.startswith(prefix) & (key != prefix) & (F.instr(rest, "/") == 0)


def document_id_for(bucket: Column, base: Column) -> Column:
    """Deterministic document id: a retry of the same upload gets the same id."""
    return F.sha2(F.concat_ws("|", bucket, base), 256)


# destination keys --------------------------------------------------------

def text_page_key(doc: Column, page_ordinal: Column) -> Column:
    return F.format_string("staging/%s/text_page_%d.txt", doc, page_ordinal)


def combined_key(doc: Column) -> Column:
    return F.format_string("staging/%s/combined.txt", doc)


def result_key(doc: Column) -> Column:
    return F.format_string("results/%s_response.json", doc)


def complete_key(page_key: Column, doc: Column) -> Column:
    """Every occurrence of 'incoming/' is replaced, as the mover does."""
    return F.replace(page_key, F.lit(INCOMING_PREFIX), F.concat(F.lit("complete/"), doc, F.lit("/")))


def archive_key(zip_name: Column) -> Column:
    return F.concat(F.lit("archive/"), zip_name)


def top_folder(key: Column) -> Column:
    return F.element_at(F.split(key, "/", -1), 1)
