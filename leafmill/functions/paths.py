"""Paths and names: folding, containment, suffixes, archive member names."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill import fixed
from leafmill.functions.text import strip

# Longest suffix taken over from an inline name, and the default.
INLINE_SUFFIX_CHARS = 16
INLINE_SUFFIX = ".txt"

_ARCHIVE_NAME = "(" + "|".join(s.replace(".", r"\.") for s in fixed.FORMAT_FAMILIES["archive"]) + r")\z"


def allowed_roots(env: Mapping[str, str] | None = None, prefix: str = "LEAFMILL_") -> list[str]:
    """Directories inputs may live under: ``<prefix>ROOTS``, else ``<prefix>DIR``, else ``~/.leafmill``."""
    env = os.environ if env is None else env
    listed = env.get(prefix + "ROOTS", "").strip() or env.get(prefix + "DIR", "").strip()
    listed = listed or os.path.join(os.path.expanduser("~"), ".leafmill")
    return [os.path.realpath(os.path.expanduser(root.strip())) for root in listed.split(os.pathsep) if root.strip()]


# A scheme has two letters at least, so a drive is none.  ``file:`` with or
# without an authority is the local file system.
_STORE = r"\A([A-Za-z][A-Za-z0-9+.-]+://[^/]*)(?=/|\z)"
_FILE = r"\A(?i:file):(?://[^/]*)?(?=/)"


def local_form(location: Column) -> Column:
    """A location with its ``file:`` scheme taken off."""
    return F.regexp_replace(location, _FILE, "")


def store_of(location: Column) -> Column:
    """Scheme and authority of a location in a store, in lower case; empty for a local one."""
    return F.lower(F.regexp_extract(local_form(location), _STORE, 1))


def fold_location(location: Column) -> Column:
    """A path or URI folded within its store; null for a relative one."""
    bare = local_form(location)
    store = F.regexp_extract(bare, _STORE, 1)
    inside = F.substring(bare, F.length(store) + 1, F.length(bare))
    folded = fold_path(F.when((store != "") & (inside == ""), F.lit("/")).otherwise(inside))
    return F.concat(F.lower(store), folded)


def fold_root(root: str) -> str:
    """A root in the form of ``fold_location``."""
    bare = re.sub(_FILE, "", root.strip())
    store = re.match(_STORE.replace(r"\z", r"\Z"), bare)
    prefix = store[1].lower() if store else ""
    kept: list[str] = []
    for part in bare[len(prefix) :].split("/"):
        if part == "..":
            del kept[-1:]
        elif part not in ("", "."):
            kept.append(part)
    return prefix + "/" + "/".join(kept)


def fold_path(path: Column) -> Column:
    """An absolute path without ``.``, ``..``, doubled or trailing slashes; null for a relative one.

    ``..`` at the top stays at the top.
    """
    def step(kept: Column, part: Column) -> Column:
        return (
            F.when(part.isin("", "."), kept)
            .when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
            .otherwise(F.array_append(kept, part))
        )

    start = F.array().cast("array<string>")
    folded = F.aggregate(F.split(path, "/"), start, step, lambda kept: F.concat(F.lit("/"), F.array_join(kept, "/")))
    return F.when(path.startswith("/"), folded)


def within_roots(path: Column, roots: Iterable[str]) -> Column:
    """Whether a folded location is a root or beneath one, in the same store and by whole segments.

    The roots are job settings, so they sit in the plan as literals: a filter,
    not a join.  Without roots nothing passes.
    """
    inside = F.lit(False)
    for root in map(fold_root, roots):
        inside = inside | (path == F.lit(root)) | path.startswith(root.rstrip("/") + "/")
    return F.coalesce(inside, F.lit(False))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_archive(name: Column) -> Column:
    """Whether the name, in any case, ends as an archive's does."""
    return F.lower(name).rlike(_ARCHIVE_NAME)


def format_suffix(name: Column) -> Column:
    """Lower-cased suffix that decides the format, compound ones whole; empty when there is none."""
    return F.regexp_extract(F.lower(base_name(name)), r"[^/](\.tar\.(?:gz|bz2|xz)|\.[^./]+)\z", 1)


def inline_suffix(filename: Column) -> Column:
    """The last suffix of a caller's file name, all an inline document takes from it.

    Only the last part counts, so ``a.tar.gz`` gives ``.gz``.
    """
    named = F.coalesce(F.nullif(filename, F.lit("")), F.lit("document.txt"))
    # Trailing slashes and lone-dot segments do not name anything.
    path = F.regexp_replace(F.replace(named, F.lit("\\"), F.lit("/")), r"(?:/\.?)+\z", "")
    suffix = F.regexp_extract(base_name(path), r"(?s)\A.+(\.[^.]+)\z", 1)
    return F.coalesce(F.nullif(F.substring(suffix, 1, INLINE_SUFFIX_CHARS), F.lit("")), F.lit(INLINE_SUFFIX))


def member_name(name: Column) -> Column:
    """A member's relative name with ``\\`` as ``/`` and empty or ``.`` segments gone."""
    parts = F.filter(F.split(F.replace(name, F.lit("\\"), F.lit("/")), "/"), lambda part: ~part.isin("", "."))
    return F.coalesce(F.nullif(F.array_join(parts, "/"), F.lit("")), F.lit("."))


def member_name_refusal(name: Column) -> Column:
    """Why an archive member's name is refused; null for a good one.  Names are never repaired."""
    quoted = F.concat(F.lit("archive member `"), name, F.lit("`"))
    forward = F.replace(name, F.lit("\\"), F.lit("/"))
    return (
        F.when(name.isNull() | name.isin("", ".", "./"), F.lit("archive member has an empty name"))
        .when(forward.startswith("/") | forward.rlike(r"\A[A-Za-z]:"), F.concat(quoted, F.lit(" has an absolute path")))
        .when(
            F.array_contains(F.split(forward, "/"), ".."),
            F.concat(quoted, F.lit(" takes a parent-directory step")),
        )
    )


def clean_path(path: Column) -> Column:
    return strip(F.coalesce(path, F.lit("")))
