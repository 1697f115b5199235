"""Paths, names and limits against Python's own."""

from __future__ import annotations

import posixpath
import random
from pathlib import PurePosixPath

from leafmill import Limits, fixed
from leafmill.functions import paths as P
from leafmill.operators.admission import formats_df


def test_fold_path(values):
    rng = random.Random(2)
    cases = ["/", "/..", "/a/../../b", "//a", "/a/./b//c/", "a/b", ""]
    cases += ["/" + "/".join(rng.choice(["a", "b", "..", ".", ""]) for _ in range(rng.randrange(7))) for _ in range(200)]
    expected = [posixpath.normpath("/" + c.lstrip("/")) if c.startswith("/") else None for c in cases]
    assert values(P.fold_path, cases) == expected


def test_containment_goes_by_segments(values):
    cases = ["/r", "/r/a", "/rx/a", "/", "/data/x", None]
    assert values(lambda x: P.within_roots(x, ["/r", "/data/"]), cases) == [True, True, False, False, True, False]
    assert values(lambda x: P.within_roots(x, ["/"]), cases) == [True, True, True, True, True, False]
    assert values(lambda x: P.within_roots(x, []), cases) == [False] * 6


def test_inline_suffix(values):
    cases = ["a.tar.gz", "a", ".hidden", "a.b/c", "x\\y.PDF", "a.", "n." + "q" * 30, "..a.md", "a.md/", "dir.x/..", "", None, "a b.t x"]

    def python(name):
        suffix = PurePosixPath((name or "document.txt").replace("\\", "/")).suffix[:16]
        return ".txt" if suffix in ("", ".") else suffix

    assert values(P.inline_suffix, cases) == [python(c) for c in cases]


def test_format_suffix_and_archives(values):
    cases = ["A.TAR.GZ", "a.tgz", "b/.hidden", "x.md", "noext", "a.b/c", "x.tar.zip", ".tar.gz", "a.gz", "a.TXZ"]
    assert values(P.format_suffix, cases) == [".tar.gz", ".tgz", "", ".md", "", "", ".zip", ".gz", ".gz", ".txz"]
    assert values(P.is_archive, cases) == [True, True, False, False, False, False, True, True, False, True]


def test_member_names(values):
    bad = {
        "": "empty name", ".": "empty name", "./": "empty name", "/a": "absolute", "\\a": "absolute", "C:\\x": "absolute", "c:/x": "absolute",
        "..": "parent-directory", "a/../b": "parent-directory", "a\\..\\b": "parent-directory", "../a": "parent-directory",
    }
    for name, reason in zip(bad, values(P.member_name_refusal, list(bad))):
        assert bad[name] in reason, (name, reason)
    good = {"a": "a", "./a//b/.": "a/b", "a\\b": "a/b", "a..b": "a..b", "...": "..."}
    assert values(P.member_name_refusal, list(good)) == [None] * len(good)
    assert values(P.member_name, list(good)) == list(good.values())


def test_roots_prefer_the_list_over_the_folder_over_home(tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    assert P.allowed_roots({"LEAFMILL_ROOTS": f" {a}: :{b}", "LEAFMILL_DIR": "/x"}) == [str(a), str(b)]
    assert P.allowed_roots({"LEAFMILL_ROOTS": "", "LEAFMILL_DIR": str(a)}) == [str(a)]
    assert P.allowed_roots({})[0].endswith("/.leafmill")


def test_limits_from_the_environment():
    env = {"LEAFMILL_MAX_INPUT_BYTES": "5", "LEAFMILL_MAX_JOBS": "junk", "LEAFMILL_MAX_ELEMENTS": "0", "LEAFMILL_TIMEOUT_SECS": " 77 "}
    limits = Limits.from_env(env)
    assert (limits.max_input_bytes, limits.max_jobs, limits.max_elements, limits.timeout_secs) == (1 << 20, None, 0, 77)
    assert Limits().max_output_bytes is None and Limits().max_elements is None


def test_formats(spark):
    rows = formats_df(spark).collect()
    listed = [row.suffix for row in rows]
    assert listed == sorted(listed) and len(listed) == 35
    assert {".pdf", ".docx", ".eml"} <= set(listed)
    assert not {".mp3", ".wav", ".mp4", ".msg"} & set(listed)
    assert {row.family for row in rows if row.built_in} == set(fixed.BUILT_IN_FAMILIES)
