"""Column functions for paths and text (all JVM-side expressions)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokloom.config import PY_SPACE_CLASS, STORAGE_WIDTH_LIMIT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_name(path) -> Column:
    """Last path part."""
    return F.element_at(F.split(_c(path), "/"), -1)


def suffix(path) -> Column:
    """Lower-case suffix of the last path part, '' when there is none.

    A leading dot does not start a suffix ('.gitignore' -> ''), a trailing
    dot is no suffix ('z.' -> ''), only the last dot counts ('x.tar.gz' ->
    '.gz').
    """
    return F.lower(F.regexp_extract(file_name(path), r"[^.].*?(\.[^.]+)$", 1))


def path_parts(path) -> Column:
    """Sort key that orders paths part by part ('a/b' < 'a-b')."""
    return F.split(_c(path), "/")


def excluded_substring(path, patterns) -> Column:
    """True when a lower-case pattern is a substring of a path part.

    A pattern without '/' is inside some part exactly when it is inside the
    whole path, so one ``contains`` per pattern is enough; a pattern with a
    '/' can never be inside a single part.
    """
    pats = [p.lower() for p in patterns if "/" not in p]
    if not pats:
        return F.lit(False)
    low = F.lower(_c(path))
    cond = F.lit(False)
    for p in pats:
        cond = cond | low.contains(p)
    return cond


def glob_to_regex(pattern: str) -> str:
    """Translate a shell glob to an anchored Java regex."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = pattern.find("]", i + 2 if pattern[i + 1:i + 2] in ("!", "]") else i + 1)
            if j < 0:
                out.append(re.escape(ch))
            else:
                body = pattern[i + 1:j]
                if body.startswith("!"):
                    body = "^" + body[1:]
                out.append("[" + body.replace("\\", "\\\\") + "]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    return "^(?:" + "".join(out) + ")$"


def excluded_glob(path, patterns) -> Column:
    """True when a lower-case path part matches one of the globs."""
    if not patterns:
        return F.lit(False)
    rx = "|".join(glob_to_regex(p.lower()) for p in patterns)
    return F.exists(F.split(F.lower(_c(path)), "/"), lambda part: part.rlike(rx))


def py_strip(text) -> Column:
    """Python ``str.strip()``: Unicode whitespace plus \\x1c-\\x1f."""
    return F.regexp_replace(
        _c(text), f"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+\\z", "")


def normalize_newlines(text) -> Column:
    """Text-mode read: '\\r\\n' and lone '\\r' become '\\n'."""
    return F.regexp_replace(_c(text), "\r\n?", "\n")


def compose_doc(doc, code) -> Column:
    """Docstring + code document; plain code when the docstring is empty."""
    d, c = _c(doc), _c(code)
    return F.when(F.length(d) > 0,
                  F.concat(F.lit('"""\n'), d, F.lit('\n"""\n'), c)).otherwise(c)


def padded_name(idx, ext) -> Column:
    """Zero-padded output file name, e.g. 00000042.py."""
    return F.format_string("%08d%s", _c(idx), _c(ext))


def storage_dtype(vocab_size) -> Column:
    return F.when(_c(vocab_size) < STORAGE_WIDTH_LIMIT, F.lit("uint16")).otherwise(F.lit("uint32"))


def cut_at_blank_line(text) -> Column:
    """Keep a completion up to its first blank line."""
    return F.substring_index(_c(text), "\n\n", 1)


def step_number(name) -> Column:
    """'step_0001000' -> 1000."""
    return F.element_at(F.split(_c(name), "_"), 2).cast("int")
