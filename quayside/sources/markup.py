"""Pages as one array of tag events, made in a single pass inside the JVM.

A page is split into tokens (tags with their quoted attributes, text,
comments; scripts and styles as one token each) and tokens become events;
folds over them with a state of a few numbers find where elements end.
Everything that is read from a page is read from that array, so quoting
(double, single or none), the order of attributes and of class names, upper
case, and nested tables or blocks do not matter. An end tag without a start
is ignored by the depths; a row or cell also ends where the next one of its
table begins.

Steps that several fields share are fixed by :func:`step`: a generator over
one struct, which the optimiser neither inlines nor evaluates twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: comment, script or style with its content, tag, declaration, text, stray bracket
TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
         r"|</?[a-z](?:[^>\"']++|\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))*+(?:>|\z)|<[!?/][^>]*+(?:>|\z)|[^<]++|<")
TAGS = ("table", "tr", "td", "th", "div", "a", "svg")  # with events; other tags only part text
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
Test = Callable[[Column], Column]


def decode_entities(c: Column) -> Column:
    out = c
    for ent, ch in ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return F.when(F.contains(c, F.lit("&")), out).otherwise(c)


def step(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the named columns, each computed once."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def let(value: Column, use: Test) -> Column:
    """``use(value)`` with the value computed once: inside the function of a
    higher-order function an expression is evaluated at each mention, and for
    every element."""
    return F.transform(F.array(value), use)[0]


def attribute(e: Column, name: str) -> Column:
    """Value of an event's attribute, NULL when its tag has none of that name.
    The attributes before it are stepped over one by one, so its name inside
    another's quotes does not count."""
    value = r"(\"[^\"]*\"|'[^']*'|[^\s>]*)"
    found = lambda t: F.regexp_extract(t, rf"(?is)^<[a-z0-9]+(?:[\s/]+[^\s=>/]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+))?)*?[\s/]+{name}\s*=\s*{value}", 1)

    def bare(v: Column) -> Column:
        quoted = v.startswith('"') | v.startswith("'")
        return F.when(v != "", decode_entities(F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)))

    return let(e["t"], lambda t: F.when(F.contains(t, F.lit("=")), let(found(t), bare)))


EVENT = "struct<p:int,kind:string,name:string,t:string>"


def _events(tokens: Column) -> Column:
    named = F.transform(tokens, lambda t: F.struct(
        t.alias("t"), F.when(t.startswith("<"), F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))).alias("name")))
    # a bracket that starts no tag is text
    kept = F.filter(named, lambda x: x["name"].isNull() | x["name"].isin(*TAGS) | (x["t"] == "<"))
    return F.transform(kept, lambda x, p: F.struct(
        p.alias("p"), F.when(x["name"].isNull() | (x["t"] == "<"), F.lit("text")).when(x["t"].startswith("</"), F.lit("close"))
        .when(x["t"].endswith("/>") & (x["name"] != "a"), F.lit("both")).otherwise(F.lit("open")).alias("kind"),
        F.coalesce(x["name"], F.lit("")).alias("name"), x["t"].alias("t")))


def page_events(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """``keep`` and ``ev``: the page's events in order, each with its place ``p``."""
    tokens = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(TOKEN), F.lit(0))
    return step(pages, keep, ev=_events(tokens))


def with_table_depth(ev: Column) -> Column:
    """The events with ``table``, the number of tables open after each. The
    fold goes over the table tags alone; other events look theirs up."""
    tags = F.filter(ev, lambda e: (e["name"] == "table") & (e["kind"] != "both"))

    def add(acc: Column, e: Column) -> Column:
        change = F.when(e["kind"] == "open", 1).otherwise(-1)
        before = F.coalesce(F.try_element_at(acc, F.lit(-1))["depth"], F.lit(0))
        return F.array_append(acc, F.struct(e["p"].alias("p"), F.greatest(before + change, F.lit(0)).alias("depth")))

    depths = F.aggregate(tags, F.array().cast("array<struct<p:int,depth:int>>"), add)
    return let(depths, lambda d: F.transform(ev, lambda e: F.struct(
        F.coalesce(F.try_element_at(F.filter(d, lambda x: x["p"] <= e["p"]), F.lit(-1))["depth"], F.lit(0)).alias("table"),
        *[e[n].alias(n) for n in ("p", "kind", "name", "t")])))


# --- reading an event array ----------------------------------------------------------

def first(ev: Column, test: Test) -> Column:
    """The first event for which ``test`` holds, or NULL."""
    return F.try_element_at(F.filter(ev, test), F.lit(1))


def opens(name: str, *classes: str) -> Test:
    """An element of that name with these classes, in any order."""
    def test(e: Column) -> Column:
        ok = e["name"] == name  # cheap and rare things first
        for c in classes:
            ok = ok & F.contains(e["t"], F.lit(c))
        ok = ok & (e["kind"] != "close") & (e["kind"] != "text")
        if classes:
            ok = ok & let(F.split(F.coalesce(attribute(e, "class"), F.lit("")), r"\s+"),
                          lambda held: F.size(F.array_intersect(held, F.array(*map(F.lit, classes)))) == len(set(classes)))
        return ok
    return test


def closes(name: str) -> Test:
    return lambda e: (e["name"] == name) & (e["kind"] == "close")


def between(ev: Column, start: Column, end: Column) -> Column:
    """Events after ``start`` and before ``end`` (places); empty when ``start``
    is NULL, up to the last when ``end`` is. The places of an array, or of a
    part of one, have no gaps, so the part is cut out and not searched for."""
    def cut(b: Column) -> Column:
        first_place = F.try_element_at(b["ev"], F.lit(1))["p"]
        skip = F.greatest(b["start"] + 1 - first_place, F.lit(0))
        size = F.size(b["ev"])
        last = F.least(F.coalesce(b["end"] - first_place, size), size)
        held = b["start"].isNotNull() & (size > 0)
        return F.when(held, F.slice(b["ev"], skip + 1, F.greatest(last - skip, F.lit(0)))).otherwise(F.slice(b["ev"], F.lit(1), F.lit(0)))

    return let(F.struct(ev.alias("ev"), start.alias("start"), end.alias("end")), cut)


def end_of(ev: Column, start: Column, name: str) -> Column:
    """Place of the tag that closes the element ``name`` opened at ``start`` (a
    place), or NULL. A fold whose state is two numbers."""
    def add(acc: Column, e: Column) -> Column:
        depth = acc["depth"] + F.when(acc["depth"] == 0, 0).when(e["kind"] == "open", 1).otherwise(-1)
        return F.struct(depth.alias("depth"), F.when(acc["depth"] > 0, e["p"]).otherwise(acc["at"]).alias("at"))

    tags = F.filter(ev, lambda e: (e["name"] == name) & (e["p"] > start) & ((e["kind"] == "open") | (e["kind"] == "close")))
    state = F.struct(F.lit(1).alias("depth"), F.lit(-1).alias("at"))
    return F.when(start.isNotNull(), F.aggregate(tags, state, add, lambda acc: F.when(acc["depth"] == 0, acc["at"])))


def strings(ev: Column) -> Column:
    """Texts of the events, trimmed, without blank ones."""
    texts = F.transform(F.filter(ev, lambda e: e["kind"] == "text"), lambda e: F.regexp_replace(decode_entities(e["t"]), r"^\s+|\s+$", ""))
    return F.filter(texts, lambda t: t != "")


def text_of(ev: Column) -> Column:
    return F.array_join(F.transform(F.filter(ev, lambda e: e["kind"] == "text"), lambda e: decode_entities(e["t"])), "")
