"""Values that have to be exactly these for results to agree.

Only data lives here: names, formats, message texts, codes.
"""

from __future__ import annotations

# File extensions by family.  The first six families are turned
# into blocks here; the others need a converter supplied by the user.
FORMAT_FAMILIES: dict[str, tuple[str, ...]] = {
    "html": (".html", ".htm", ".xhtml"),
    "markdown": (".md",),
    "asciidoc": (".adoc", ".asciidoc"),
    "text": (".txt", ".text"),
    "csv": (".csv",),
    "xml": (".xml",),
    "pdf": (".pdf",),
    "office": (".docx", ".pptx", ".xlsx"),
    "opendocument": (".odt", ".odp", ".ods"),
    "latex": (".tex",),
    "ebook": (".epub",),
    "email": (".eml",),
    "image": (".png", ".jpg", ".jpeg", ".tiff", ".tif", ".bmp", ".webp"),
    "archive": (".zip", ".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tbz2", ".tar.xz", ".txz"),
}
BUILT_IN_FAMILIES = ("html", "markdown", "asciidoc", "text", "csv", "xml")

# Error codes.
LIBRARY_MISSING = "library_missing"
MISSING_DEPENDENCY = "missing_dependency"
UNSUPPORTED_FORMAT = "unsupported_format"
PARSE_FAILED = "parse_failed"
INPUT_REJECTED = "input_rejected"
TIMEOUT = "timeout"

# Job states and the events that lead to them.
QUEUED, RUNNING, SUCCEEDED, FAILED, CANCELLED = "queued", "running", "succeeded", "failed", "cancelled"
TERMINAL_STATES = (SUCCEEDED, FAILED, CANCELLED)

# OCR engine names an option may carry.
OCR_ENGINES = ("easyocr", "tesseract", "tesserocr", "rapidocr", "ocrmac")

# Words in a converter's failure that mean "no such format".
UNSUPPORTED_MARKERS = ("unsupported", "not supported", "no pipeline")

# Converter states.
FAILED_STATES = ("FAILURE", "SKIPPED")
PARTIAL_STATE = "PARTIAL_SUCCESS"
REPORTED_ERRORS = 4

# Named block categories (the DocLayNet label set).
TITLE, SECTION_HEADER, TEXT, LIST_ITEM = "Title", "Section-header", "Text", "List-item"
TABLE, CAPTION, PAGE_HEADER, PAGE_FOOTER = "Table", "Caption", "Page-header", "Page-footer"

# The white space Python's str.strip and str.isspace know.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
