"""Elements of stored HTML by CSS selector, in Catalyst (the ground of H1-H6).

A page's text is cut into an array of tokens (tags, comments, text).  One
``aggregate`` over its tags carries the open elements and yields the span of every
element that a selector matches, so nesting, unclosed and implied end tags are
right; the text of an element is put together from the tokens of its span.
Narrow: array functions only, no shuffle, no Python.

Selectors (``parse_selector``): ``tag``, ``.class``, ``#id``, ``[attr]``, ``[attr="v"]``,
``[attr*="v"]`` and runs of them, ``*``, descendants (blank), lists (comma).  A
selector's compounds are numbered bits; an open element holds the bits that it
or its ancestors reached, so a descendant match is one shift.

Tree rules covered: void elements; ``li``, ``dt``/``dd``, ``option``, ``tr``, ``td``/``th`` and
``p`` end where the next one or a block starts; an end tag closes what it
encloses, and is ignored without an open element of its name in reach."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: element classes of HTML -----------------------------------
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "script", "style"]
ENDS_P = ["address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"]
SPECIAL = sorted({*ENDS_P, "body", "button", "caption", "center", "dd", "dt", "head", "html", "li", "option", "optgroup", "select",
                  "summary", "tbody", "td", "template", "textarea", "tfoot", "th", "thead", "title", "tr"})
SCOPE = ["caption", "html", "table", "td", "template", "th"]
# lines of rendered text end at these
BLOCKS = sorted({*ENDS_P, "body", "caption", "center", "dd", "dt", "html", "li", "optgroup", "option", "summary", "tbody", "tfoot",
                 "thead", "tr"})
# start tag -> (elements it ends, nearest first choice, ..., elements that hide them)
ENDED_BY_START = {"li": (["li", "p"], ["menu", "ol", "ul", *SCOPE]), "dt": (["dt", "dd", "p"], ["dl", *SCOPE]),
                  "dd": (["dd", "dt", "p"], ["dl", *SCOPE]), "option": (["option"], ["select", "datalist"]),
                  "optgroup": (["optgroup", "option"], ["select"]), "tr": (["tr"], ["table"]), "td": (["td", "th"], ["table"]),
                  "th": (["th", "td"], ["table"]), "a": (["a"], SPECIAL)} | {
                      name: (["p"], ["button", *SCOPE]) for name in ENDS_P}
HIDDEN_FROM_END = {"li": ["menu", "ol", "ul", *SCOPE], "p": ["button", *SCOPE], "td": ["table"], "th": ["table"], "tr": ["table"],
                   "tbody": ["table"], "thead": ["table"], "tfoot": ["table"], "table": ["template"], "body": ["template"], "html": ["template"]}
NAMED_ENTITIES = {"amp": "&", "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "copy": "©", "middot": "·",
                  "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "ntilde": "ñ", "uuml": "ü",
                  "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "Ntilde": "Ñ", "Uuml": "Ü",
                  "deg": "°", "ordm": "º", "euro": "€"}

# comment | script, style | declaration | tag | text | a lone <
TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)|<[!?][^>]*>|"
         r"""</?[a-z][^\s/>]*+(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+>|[^<]++|<""")
ATTRIBUTE = r"""[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+"""
BLOCK_TAGS = 128  # tags that are folded before their spans join the others
INLINE, BLOCK, BREAK = "\x01", "\x02", "\x03"  # places of tags in a text that is being put together


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where a lambda uses it.  The
    result is copied, so it suits small ones and what is made once a page."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sql(value: str | list[str]) -> str:
    """SQL literal of a text or of an array of texts (one expression, built at once)."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"array({', '.join(map(_sql, value))})" if value else "cast(array() as array<string>)"


def _names(names: list[str]) -> Column:
    return F.expr(_sql(names))


def _map(table: dict) -> Column:
    return F.expr(f"map({', '.join(_sql(x) for item in table.items() for x in item)})")


def _among(name: Column, names: list[str]) -> Column:
    return F.array_contains(_names(names), name)


# -------------------------------------------------------------- selectors ----
class Compound(NamedTuple):
    """Simple selectors that one element has to meet."""

    tag: str | None
    classes: tuple[str, ...]
    attributes: tuple[tuple[str, str, str], ...]  # (name, operator, value)


SIMPLE = re.compile(r"""\*|[.#]?-?[A-Za-z_][\w-]*|\[\s*([\w-]+)\s*(?:(\*?=)\s*(?:"([^"]*)"|'([^']*)'|([^\]\s]+))\s*)?\]""")


def parse_selector(selector: str) -> list[list[Compound]]:
    """Alternatives of a selector, each the compounds of a descendant chain."""
    chains: list[list[Compound]] = [[]]
    for piece in re.findall(r"""\[[^\]]*\]|[^\s,\[]+|\s*,\s*|\s+|\[""", selector.strip()):
        if piece.strip() == ",":
            chains.append([])
        if piece.strip() in ("", ","):
            joined = False
            continue
        found, at = [], 0
        while at < len(piece):
            m = SIMPLE.match(piece, at)
            if not m:
                raise ValueError(f"unsupported selector: {selector!r}")
            found.append(m)
            at = m.end()
        tag = next((m[0].lower() for m in found if m[0][0] not in "*.#["), None)
        classes = tuple(m[0][1:] for m in found if m[0][0] == ".")
        attributes = tuple((m[1].lower(), m[2] or "", m[3] or m[4] or m[5] or "") for m in found if m[1])
        attributes += tuple(("id", "=", m[0][1:]) for m in found if m[0][0] == "#")
        if chains[-1] and joined:  # the same element: an attribute after what stands before it
            last = chains[-1].pop()
            tag, classes, attributes = last.tag or tag, last.classes + classes, last.attributes + attributes
        chains[-1].append(Compound(tag, classes, attributes))
        joined = True
    if not all(chains):
        raise ValueError(f"unsupported selector: {selector!r}")
    return chains


# ----------------------------------------------------------------- tokens ----
def tokens(html: Column) -> Column:
    return F.regexp_extract_all(F.translate(html, INLINE + BLOCK + BREAK, ""), F.lit(TOKEN), 0)


def is_text(token: Column) -> Column:
    return ~token.startswith("<") | (F.length(token) == 1)


def tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag (the first of that name), entities
    decoded; '' for one without a value, null without the attribute."""
    written = F.regexp_extract_all(F.regexp_replace(tag, r"^<[^\s/>]+|>$", ""), F.lit(ATTRIBUTE), 0)
    hit = F.get(F.filter(written, lambda a: a.rlike(rf"(?is)^{re.escape(name)}\s*(?:=|$)")), 0)
    value = F.regexp_replace(hit, r"""(?s)^[^=]*(?:=\s*(?:"(.*)"|'(.*)'|(.*)))?$""", "$1$2$3")
    return F.when(tag.rlike(rf"(?i)[\s/\"']{re.escape(name)}[\s=/>]"), decode_entities(value))


def decode_entities(text: Column) -> Column:
    """Decimal and hexadecimal character references and the named ones of
    ``NAMED_ENTITIES``; anything else stays as it is."""
    def decoded(part: Column) -> Column:
        """A piece of text that stood after an ampersand."""
        def char(ref: Column) -> Column:
            hexadecimal = F.conv(F.substring(ref, 3, 6), 16, 10)
            code = F.when(ref.rlike("^#[xX]"), hexadecimal).when(ref.startswith("#"), F.substring(ref, 2, 7)).try_cast("int")
            known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
            numeric = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
            found = F.coalesce(numeric, F.try_element_at(_map(NAMED_ENTITIES), ref))
            return F.coalesce(F.concat(found, F.substring(part, F.length(ref) + 2, F.length(part))), F.concat(F.lit("&"), part))
        return let(F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]+);", 1), char)
    parts = F.split(text, "&", -1)
    return F.when(text.contains("&"), F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(decoded(x))), "")).otherwise(text)


# ------------------------------------------------------------------ spans ----
def _meets(compound: Compound, tag: Column) -> Column:
    """Whether a start tag (struct with name and the attributes in use) meets a compound."""
    tests = [tag["name"] == compound.tag] if compound.tag else []
    tests += [F.concat(F.lit(" "), F.regexp_replace(tag["class"], r"\s", " "), F.lit(" ")).contains(f" {c} ") for c in compound.classes]
    for name, operator, value in compound.attributes:
        field = tag[name]
        tests.append(field.contains(value) & F.lit(value != "") if operator == "*=" else field == value if operator == "=" else field.isNotNull())
    out = F.lit(True)
    for test in tests:
        out = out & test
    return F.coalesce(out, F.lit(False))


def _tags(toks: Column, chains: list[list[Compound]]) -> Column:
    """Tags in order: (at, name, closing, mask); ``mask`` has the bits of the compounds met."""
    compounds = [c for chain in chains for c in chain]
    used = sorted({name for c in compounds for name, *_ in c.attributes} | ({"class"} if any(c.classes for c in compounds) else set()))
    placed = F.transform(toks, lambda t, i: F.struct(i.alias("at"), t.alias("t")))
    tags = F.filter(placed, lambda x: x["t"].rlike("^</?[a-zA-Z]"))
    named = F.transform(tags, lambda x: F.struct(
        x["at"], tag_name(x["t"]).alias("name"), x["t"].startswith("</").alias("closing"),
        *[F.when(~x["t"].startswith("</"), attribute(x["t"], name)).alias(name) for name in used]))

    def marked(x: Column) -> Column:
        bits = [F.when(_meets(c, x), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(compounds)]
        mask = bits[0]
        for bit in bits[1:]:
            mask = mask.bitwiseOR(bit)
        return F.struct(x["at"], x["name"], x["closing"], F.when(x["closing"], F.lit(0).cast("long")).otherwise(mask).alias("mask"))

    return F.transform(named, marked)


def _kept(stack: Column, tag: Column) -> Column:
    """How many open elements stay open when ``tag`` comes: those below the
    nearest element that it ends, all of them if there is none in reach."""
    size = F.size(stack)

    def from_top(names: Column) -> Column:
        def below(i: int) -> Column:
            """Elements below the topmost one of that name, null if there is none or it is hidden."""
            place = F.array_position(names, F.get(tag["ends"], i)).cast("int")
            over = F.slice(names, F.lit(1), place - 1)  # what lies above it
            return F.when((place == 1) | (place > 1) & ~F.arrays_overlap(over, tag["hides"]), size - place)
        return F.coalesce(below(0), below(1), below(2), size)

    return F.when((size == 0) | tag["ends"].isNull(), size).otherwise(let(F.reverse(stack["name"]), from_top))


def spans(toks: Column, selectors: list[str]) -> Column:
    """Elements that a selector matches, in document order: array of (at, end,
    hits); ``at`` and ``end`` are the places (from 0) of the start tag and of the token
    that ends it, bit i of ``hits`` stands for selector i."""
    parsed = [parse_selector(s) for s in selectors]
    chains = [chain for alternatives in parsed for chain in alternatives]
    if sum(map(len, chains)) > 62 or len(selectors) > 62:
        raise ValueError("more compound selectors than bits")
    first = bit = 0
    owner = []  # (bit of a chain's last compound, bit of its selector)
    for i, alternatives in enumerate(parsed):
        for chain in alternatives:
            first |= 1 << bit
            bit += len(chain)
            owner.append((1 << (bit - 1), 1 << i))
    long = "bigint"

    ends, hides = (_map({name: rule[i] for name, rule in ENDED_BY_START.items()}) for i in (0, 1))
    hidden = _map({name: SCOPE for name in SPECIAL} | HIDDEN_FROM_END)

    def prepared(tags: Column) -> Column:
        """Tags that matter to the spans, with what they end."""
        wanted = F.array_distinct(F.transform(F.filter(tags, lambda x: x["mask"] != 0), lambda x: x["name"]))

        def matter(names: Column) -> Column:
            kept = F.filter(tags, lambda x: (F.size(names) > 0) & (_among(x["name"], SPECIAL) | F.array_contains(names, x["name"])))
            return F.transform(kept, lambda x: F.struct(
                x["at"], x["name"], x["closing"], x["mask"],
                F.when(x["closing"], F.array(x["name"])).otherwise(F.try_element_at(ends, x["name"])).alias("ends"),
                F.when(x["closing"], F.coalesce(F.try_element_at(hidden, x["name"]), _names(SPECIAL))).otherwise(
                    F.try_element_at(hides, x["name"])).alias("hides")))
        return let(wanted, matter)

    def closed(some: Column, end: Column) -> Column:
        """Spans of the elements that end here."""
        hit = F.filter(some, lambda s: s["hits"] != 0)
        return F.transform(hit, lambda s: F.struct(s["at"].alias("at"), end.alias("end"), s["hits"].alias("hits")))

    def entry(stack: Column, tag: Column, kept: Column) -> Column:
        """What a start tag puts on top of the elements that stay open."""
        reached = F.when(kept > 0, F.get(stack, kept - 1)["reach"]).otherwise(F.lit(0).cast(long))

        def numbered(now: Column) -> Column:
            hits = F.lit(0).cast(long)
            for compound, selector in owner:
                hits = hits.bitwiseOR(F.when(now["own"].bitwiseAND(F.lit(compound).cast(long)) != 0, F.lit(selector).cast(long)).otherwise(
                    F.lit(0).cast(long)))
            return F.struct(kept.alias("kept"), F.struct(
                tag["at"].alias("at"), tag["name"].alias("name"), now["reach"].bitwiseOR(now["own"]).alias("reach"),
                F.when(now["own"] == 0, F.lit(0).cast(long)).otherwise(hits).alias("hits")).alias("entry"))

        def matched(reach: Column) -> Column:
            own = tag["mask"].bitwiseAND(F.lit(first).cast(long).bitwiseOR(F.shiftleft(reach, 1)))
            return let(F.struct(reach.alias("reach"), own.alias("own")), numbered)
        return let(reached, matched)

    def step(acc: Column, tag: Column) -> Column:
        def moved(acc: Column, plan: Column) -> Column:
            stack, out, kept, new = acc["stack"], acc["out"], plan["kept"], plan["entry"]
            gone = F.slice(stack, kept + 1, F.size(stack) - kept)
            left = F.when(kept == F.size(stack), stack).otherwise(F.slice(stack, F.lit(1), kept))
            opens = ~tag["closing"] & ~_among(tag["name"], VOID)
            leaf = ~tag["closing"] & (new["hits"] != 0) & _among(tag["name"], VOID)
            ended = F.when(leaf, F.concat(gone, F.array(new))).otherwise(gone)  # a void element ends at once
            return F.struct(F.when(opens, F.concat(left, F.array(new))).otherwise(left).alias("stack"),
                            F.when(leaf | F.exists(gone, lambda s: s["hits"] != 0), F.concat(out, closed(ended, tag["at"]))).otherwise(out).alias("out"))
        plan = let(_kept(acc["stack"], tag), lambda kept: entry(acc["stack"], tag, kept))
        return F.aggregate(F.array(plan), acc, moved)

    def over_block(acc: Column, block: Column) -> Column:
        """A run of tags: what it ends is gathered apart, for a step copies what it carries."""
        inner = F.aggregate(block, F.struct(acc["stack"].alias("stack"), nothing.alias("out")), step)
        return let(inner, lambda done: F.struct(done["stack"].alias("stack"), F.concat(acc["out"], F.array(done["out"])).alias("out")))

    span = "array<struct<at:int,end:int,hits:bigint>>"
    nothing = F.expr(f"cast(array() as {span})")
    start = F.expr(f"""named_struct('stack', cast(array() as array<struct<at:int,name:string,reach:bigint,hits:bigint>>),
                                    'out', cast(array() as array<{span}>))""")
    blocks = let(let(_tags(toks, chains), prepared), lambda tags: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(tags), F.lit(1)), F.lit(BLOCK_TAGS)), lambda i: F.slice(tags, i, F.lit(BLOCK_TAGS))))
    folded = F.aggregate(blocks, start, over_block, lambda acc: F.concat(F.flatten(acc["out"]), closed(acc["stack"], F.size(toks))))
    return F.array_sort(folded)


# ------------------------------------------------------------------- text ----
def _inside(toks: Column, span: Column) -> Column:
    return F.slice(toks, span["at"] + 2, F.greatest(span["end"] - span["at"] - 1, F.lit(0)))


def content_text(toks: Column, span: Column) -> Column:
    """Text content of an element: its text as it stands, tags leave nothing."""
    return F.replace(decode_entities(F.array_join(F.filter(_inside(toks, span), is_text), INLINE)), F.lit(INLINE), F.lit(""))


def flat_text(toks: Column, span: Column) -> Column:
    """Text of an element in one line, a blank for every tag."""
    pieces = F.transform(_inside(toks, span), lambda t: F.when(is_text(t), t).otherwise(F.lit(" ")))
    x = F.regexp_replace(decode_entities(F.array_join(pieces, "")), r"\s+", " ")
    return F.regexp_replace(x, r"\A | \z", "")


def rendered_text(toks: Column, span: Column) -> Column:
    """Text of an element as a browser lays it out: lines end at ``br`` and at the
    edges of block elements, other white space is one blank."""
    def piece(t: Column) -> Column:
        name = tag_name(t)
        mark = F.when(name == "br", F.lit(BREAK)).when(_among(name, BLOCKS), F.lit(BLOCK)).when(
            _among(name, ["td", "th"]), F.lit(" ")).otherwise(F.lit(INLINE))
        return F.when(is_text(t), t).otherwise(mark)

    x = decode_entities(F.array_join(F.transform(_inside(toks, span), piece), INLINE))
    x = F.regexp_replace(F.replace(x, F.lit(INLINE), F.lit("")), r"\s+", " ")
    x = F.regexp_replace(x, rf" ?([{BLOCK}{BREAK}]) ?", "$1")
    x = F.regexp_replace(x, rf"(\A|[{BLOCK}{BREAK}]){BLOCK}+", "$1")
    x = F.regexp_replace(x, rf"{BLOCK}\z", "")
    return F.regexp_replace(F.translate(x, BLOCK + BREAK, "\n\n"), r"\A | \z", "")


def elements(html: Column, selectors: list[str], text: Callable[[Column, Column], Column], first: int | None = None) -> Column:
    """For every selector the texts of its elements in document order (at most the
    ``first`` ones): array of arrays, from one pass over the page."""
    def texts(toks: Column) -> Column:
        def picked(found: Column) -> Column:
            def one(i: int) -> Column:
                hit = F.filter(found, lambda s: s["hits"].bitwiseAND(F.lit(1 << i).cast("long")) != 0)
                hit = hit if first is None else F.slice(hit, 1, first)
                return F.transform(hit, lambda s: F.struct(F.lit(i).alias("of"), s["at"], s["end"]))
            return F.flatten(F.array(*[one(i) for i in range(len(selectors))]))

        def dealt(read: Column) -> Column:
            return F.array(*[F.transform(F.filter(read, lambda r: r["of"] == i), lambda r: r["text"]) for i in range(len(selectors))])

        chosen = let(spans(toks, selectors), picked)
        return let(F.transform(chosen, lambda s: F.struct(s["of"], text(toks, s).alias("text"))), dealt)
    return F.when(html.isNotNull(), let(tokens(html), texts))
