"""String operators as columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings that make a token without a folder look like a path (fixed values: the source languages' endings, language by language, then those
#: of other text files).
EXTENSIONS = """
cls trigger apex sh bash zsh ksh bats c h cs csx csproj sln cairo circom clj cljs cljc edn lisp lsp cl asd cpp cc cxx hpp hh hxx dart dockerfile
ex exs go mod sum groovy gradle gvy hack hhi tf tfvars hcl html htm java js mjs cjs jsx json jsonnet libsonnet jl kt kts lua rockspec move ml mli opam
pl pm t psgi cgi fcgi PL php phtml ps1 psm1 psd1 promql rules proto py pyi ql qll r R Rmd rb rake gemspec rs scala sc sbt scm ss sld sol swift
ts mts cts tsx vue xml xsd xsl plist svg yaml yml
sql css scss less svelte md rst toml lock cfg ini txt
""".split()
_W = r"\p{L}\p{N}_"
#: A path-like token (a fixed value of the rule): with a folder any ending, without one a known ending, and no part of a longer token.
PATH_LIKE = rf"(?<![{_W}/.-])((?:[{_W}.-]+/)+[{_W}.-]+\.[{_W}]+|[{_W}-]+\.(?:{'|'.join(EXTENSIONS)}))(?![{_W}/])"
WORDS = r"[\p{L}\p{N}_]+"


def words(text: Column) -> Column:
    """Unicode words, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORDS})"), 1)


def identifier_tokens(name: Column, shortest: int = 3) -> Column:
    """Parts of camelCase, ACRONYMWord and snake_case names of at least `shortest` letters, lower-cased, and the whole name."""
    parted = F.regexp_replace(F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1 $2"), r"([A-Z]+)([A-Z][a-z])", "$1 $2")
    parts = F.filter(F.split(F.lower(parted), r"[^a-z0-9]+"), lambda p: F.length(p) >= shortest)
    return F.array_union(parts, F.array(F.lower(name)))


def path_mentions(text: Column) -> Column:
    """Path-like tokens in order, without dots and slashes at their ends."""
    return F.transform(F.regexp_extract_all(text, F.lit(PATH_LIKE), 1), lambda p: F.regexp_replace(p, r"^[./]+|[./]+$", ""))


def stem(path: Column) -> Column:
    """A file's name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def mentions_identifier(text: Column, name: Column, file: Column | None = None) -> Column:
    """A word of the text is a part of the name or of its file's stem, or either as a whole."""
    banned = identifier_tokens(name)
    if file is not None:
        banned = F.array_union(banned, identifier_tokens(stem(file)))
    return F.arrays_overlap(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9_]+)"), 1), banned)


def tokens(text: Column) -> Column:
    """Runs without white space."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def is_prose(text: Column, least: int = 3, share: float = 0.8) -> Column:
    """At least `least` tokens, most of them wordy, and none of the punctuation of code."""
    every = tokens(text)
    wordy = F.filter(every, lambda t: t.rlike(r"^[A-Za-z][A-Za-z'’-]*[.,;:!?]?$"))
    return (F.size(every) >= least) & (F.size(wordy) >= F.size(every) * F.lit(share)) & ~text.rlike(r"[{}();=<>\[\]]")


def first_sentence(text: Column) -> Column:
    """Up to the first end mark that white space follows."""
    return F.element_at(F.split(text, r"(?<=[.!?])\s", 2), 1)


def without_prefix(text: Column, prefix: Column) -> Column:
    """Text without a leading prefix and the white space behind it."""
    rest = F.regexp_replace(F.substring(text, F.char_length(prefix) + 1, F.lit(2**31 - 1)), r"^(?U)\s+", "")
    return F.when(F.startswith(text, prefix), rest).otherwise(text)


def path_parts(path: Column) -> Column:
    """Folders and name of a path; empty and `.` parts don't count."""
    return F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))


def lies_under(parts: Column, root: Column) -> Column:
    """Path parts that start with a root's."""
    return F.slice(parts, F.lit(1), F.greatest(F.size(root), F.lit(0))) == root


def authorized(path: Column, project: Column, roots: Column) -> Column:
    """A path that stays in the project and lies at or under one of the allowed roots (an array, relative to the project). An absolute path
    counts by its place in the project; one with `..` below it never does."""
    parts, home = path_parts(path), path_parts(project)
    absolute = F.startswith(path, F.lit("/"))
    inner = F.when(absolute, F.slice(parts, F.size(home) + 1, F.greatest(F.size(parts), F.lit(1)))).otherwise(parts)
    inside = ~absolute | lies_under(parts, home)
    return inside & ~F.array_contains(inner, "..") & F.exists(roots, lambda r: lies_under(inner, path_parts(r)))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def parents(path: Column) -> Column:
    """All folders above a path, nearest first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def unfenced(text: Column) -> Column:
    """Text without a surrounding code fence."""
    return F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[a-zA-Z]*\n", ""), r"\n```$", "")


def first_json(text: Column) -> Column:
    """The outermost {...} or [...] of a text, null where there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)(\{.*\}|\[.*\])", 1), F.lit(""))


def filled(template: Column, values: Column) -> Column:
    """A template with $name replaced from a map; longer names first, unknown names stay."""
    entries = F.array_sort(F.map_entries(values), lambda a, b: F.length(b["key"]) - F.length(a["key"]))
    return F.aggregate(entries, template, lambda acc, e: F.replace(acc, F.concat(F.lit("$"), e["key"]), e["value"]))


def duration_minutes(text: Column) -> Column:
    """Minutes of `90m` or `2h`; null for anything else."""
    n = F.regexp_extract(text, r"^(\d+)([mh])$", 1)
    unit = F.regexp_extract(text, r"^(\d+)([mh])$", 2)
    return F.when(unit == "h", n.cast("int") * 60).when(unit == "m", n.cast("int"))


def names_pattern(name: str) -> str:
    """A pattern for a name whose hyphens may be blanks, ignoring case, not inside a longer word."""
    return r"(?i)(^|[^\p{L}\p{N}_-])" + r"[-\s]".join(map(re.escape, re.split(r"[-\s]+", name))) + r"($|[^\p{L}\p{N}_-])"


def matches_all(text: Column, query: str) -> Column:
    """Every word of a query occurs in the text, ignoring case; an empty query matches."""
    out = F.lit(True)
    for word in query.lower().split():
        out = out & (F.instr(F.lower(text), word) > 0)
    return out


def cleaned(text: Column) -> Column:
    """Valid UTF-8, trimmed. What isn't valid becomes U+FFFD."""
    return F.trim(F.make_valid_utf8(text))


def instant(text: Column) -> Column:
    """RFC 3339 text, up to nanoseconds, as a timestamp cut to microseconds."""
    return F.to_timestamp(F.regexp_replace(text, r"(\.\d{6})\d+", "$1"))
