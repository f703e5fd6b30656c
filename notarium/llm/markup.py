"""Problem 5: markup of other formats left in notes.

A tokenizer finds HTML, MediaWiki and LaTeX markup outside code and formulas
(in headings Markdown too; in code blocks what is not part of the block's own
language).  Clean text keeps headings, lists, code and formulas: the tokens are
rewritten to the notes' own form or dropped.

Which containers are content is decided by consensus: every text's containers
(HTML elements, templates, environments) are scored by the words in them less
those of links, scripts and attributes; the generalised tag-class paths are
voted on per host in Spark, and the texts are extracted again with the winning
paths.  What the extraction rewrites or leaves out is the markup that is
reported.  The host of a note is the first folder of its path.  A text without
any sign of markup is its own clean form and takes no part.  Only scores and
names of paths are shuffled by host, never texts.

Null texts stay null and are no case, empty ones stay empty; unknown tags such
as ``<String>``, comparisons, Windows paths, autolinks and the notes' own links
are text.  Repeated rows count once; further columns are ignored.
"""

from __future__ import annotations

import html
import html.entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import keep, ship, table
from .markdown import fences

#: Names of HTML elements.
TAGS = set(
    """a abbr acronym address applet area article aside audio b base basefont bdi bdo bgsound big blink blockquote body br
    button canvas caption center cite code col colgroup data datalist dd del details dfn dialog dir div dl dt em embed
    fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html i iframe img
    input ins kbd label legend li link main map mark marquee menu meta meter nav nobr noframes noscript object ol
    optgroup option output p param picture pre progress q rp rt ruby s samp script section select small source span
    strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul
    var video wbr o:p""".split()
)
WIKI_TAGS = set("ref references nowiki gallery syntaxhighlight poem includeonly noinclude onlyinclude".split())
#: LaTeX commands that occur without an argument in braces.
BARE = set("item bf it itshape bfseries em rm sf tt noindent newpage clearpage maketitle tableofcontents LaTeX TeX centering hline par newline linebreak pagebreak appendix small large Large footnotesize textbackslash ldots dots quad qquad hfill vfill bigskip medskip smallskip scshape ttfamily sffamily toprule midrule bottomrule".split())
NAMESPACES = "Datei|Bild|File|Image|Category|Kategorie|Media|Fichier|Archivo|Categoría|Catégorie|Bestand|Файл|Категория|Immagine|Categoria"

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:]*)((?:\s[^<>]*?)?)\s*(/?)>")
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<\?xml[^>]*>|<!\[CDATA\[.*?\]\]>", re.S | re.I)
_ENTITY = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_WIKI = re.compile(
    r"(?P<head>^[ \t]*(={1,6})[^=\n][^\n]*?={1,6}[ \t]*$)"
    r"|(?P<bold>'{2,5}(?=[^'\s])(?:(?!'')[^\n])+?'{2,5}|'''(?=\S))"
    r"|(?P<template>\{\{[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)*\}\})"
    rf"|(?P<file>\[\[(?:{NAMESPACES}):[^\]\n]*(?:\[\[[^\]\n]*\]\][^\]\n]*)*\]\])"
    r"|(?P<link>\[(?:https?|ftp)://[^\s\]]+(?:[ \t][^\]\n]*)?\](?!\())"
    r"|(?P<magic>__(?:NO)?[A-Z]{3,}__)"
    r"|(?P<table>^[ \t]*(?:\{\||\|\}|\|-[ \t]*$|\|\+))"
    r"|(?P<redirect>^#(?:REDIRECT|WEITERLEITUNG)\b)",
    re.M,
)
_LATEX = re.compile(r"(?<![\\:])\\(?:(?P<env>begin|end)\s*\{(?P<name>[A-Za-z]+\*?)\}|(?P<cmd>[A-Za-z]+)\*?(?P<brace>\s*(?:\[[^\]\n]*\])*\{)?|(?P<br>\\)(?=\s*$))", re.M)
_FORMULA = re.compile(r"\$\$[^$]+\$\$|(?<![\\$\w])\$(?!\s)(?:\\.|[^$\n\\])+?\$(?!\d)")
_INLINE = re.compile(r"(?<!`)(`+)(?!`)(.+?)(?<!`)\1(?!`)", re.S)
_MARKDOWN = re.compile(r"(\*\*|__)(?=\S).+?(?<=\S)\1|(?<![\w*])\*(?=[^\s*])[^*\n]*[^\s*]\*(?![\w*])|(?<![\w*])\*\S\*(?!\w)|(?<!\w)_(?=[^\s_])[^_\n]*[^\s_]_(?!\w)|~~(?=\S).+?~~|`[^`\n]+`|!?\[[^\]\n]*\]\([^)\n]*\)|!?\[\[[^\]\n]+\]\]|\[\^[^\]\n]+\]|\[[^\]\n]+\]\[[^\]\n]*\]|(?<!=)==(?=[^\s=])[^=\n]+==(?!=)")
_MARKS = re.compile(r"[<&]|''|\{\{|^[ \t]*=|\[\[|\[http|__[A-Z]|^[ \t]*[{|][|}+-]|\\", re.M)
_ATTR_CLASS = re.compile(r"""(?:class|id)\s*=\s*["']?([^"'>\s]+)""", re.I)
VOID = set("br hr img input meta link area base col embed source track wbr".split())
DROPPED = set("script style noscript template iframe object".split())
HEADINGS = {"chapter": 1, "part": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4, "subparagraph": 5}
SILENT = set("label ref cite citep citet pageref eqref vspace hspace includegraphics usepackage documentclass bibliography bibliographystyle newcommand renewcommand setlength index input include pagestyle date".split())


def masked(text: str) -> str:
    """The text with code and formulas blanked, every other position kept."""
    spans = [(b, e) for b, e in fences(text)]
    if spans:
        parts, at = [], 0
        for b, e in spans:
            parts += [text[at:b], "\x00" * (e - b)]
            at = e
        text = "".join([*parts, text[at:]])
    if "`" in text:
        text = _INLINE.sub(lambda m: m[0] if "\n\n" in m[0] else "\x00" * len(m[0]), text)
    if "$" in text:
        text = _FORMULA.sub(lambda m: "\x00" * len(m[0]), text)
    return text


Token = tuple[int, int, str, str, re.Match]


def tokens(shown: str) -> list[Token]:
    """(begin, end, markup, kind, match) of every piece of foreign markup in a masked text, in order."""
    out: list[Token] = []
    if not _MARKS.search(shown):
        return out
    if "<" in shown:
        for m in _COMMENT.finditer(shown):
            out.append((m.start(), m.end(), "html", "comment", m))
        for m in _TAG.finditer(shown):
            name = m[2].lower()
            if name in TAGS:
                out.append((m.start(), m.end(), "html", "tag", m))
            elif name in WIKI_TAGS:
                out.append((m.start(), m.end(), "wiki", "tag", m))
    if "&" in shown:
        for m in _ENTITY.finditer(shown):
            if m[1][0] == "#" or m[1] + ";" in html.entities.html5:
                out.append((m.start(), m.end(), "html", "entity", m))
    for m in _WIKI.finditer(shown):
        if m.lastgroup != "table" or m[0].strip() != "|-" or "{|" in shown:
            out.append((m.start(), m.end(), "wiki", m.lastgroup or "head", m))
    if "\\" in shown:
        for m in _LATEX.finditer(shown):
            before = shown[m.start() - 1] if m.start() else " "
            if m["env"]:
                out.append((m.start(), m.end(), "latex", "env", m))
            elif m["br"]:
                if "&" in shown[shown.rfind("\n", 0, m.start()) + 1 : m.start()]:
                    out.append((m.start(), m.end(), "latex", "row", m))
            elif m["brace"] or (m["cmd"] in BARE and not before.isalnum()):
                if not (before.isalnum() and not m["brace"]):
                    out.append((m.start(), m.end(), "latex", "cmd", m))
    out.sort(key=lambda t: (t[0], -t[1]))
    return out


def kinds_of_body(text: str) -> set[str]:
    """The markups left in a body."""
    return {t[2] for t in tokens(masked(text))}


def kinds_of_heading(text: str) -> set[str]:
    """The markups in a heading's text; Markdown counts here."""
    found = {t[2] for t in tokens(_FORMULA.sub(lambda m: "\x00" * len(m[0]), text)) if not (t[2] == "wiki" and t[3] == "head")}
    if _MARKDOWN.search(text) and not ("'''" in text):
        found.add("markdown")
    return found


#: Languages of code blocks whose own form a markup is.
OWN_HTML = set("html xml xhtml svg vue jsx tsx php markdown md mdx htm svelte handlebars jinja erb unknown text txt plain".split())
OWN_LATEX = set("latex tex bibtex markdown md unknown text txt plain".split())
OWN_WIKI = set("wiki wikitext mediawiki markdown md html unknown text txt plain".split())
_CODE_TAG = re.compile(r"</?(?:span|br|div|p|font|b|i|em|strong|code|pre|a|td|tr|sup|sub|mark)(?:\s+[a-z-]+=[\"'][^\"'<>]*[\"'])*\s*/?>", re.I)
_CODE_ENTITY = re.compile(r"&(?:lt|gt|amp|quot|apos|nbsp|#\d{2,5}|#x[0-9a-fA-F]{2,5});")
_CODE_LATEX = re.compile(r"\\text(?:asciitilde|backslash|asciicircum|bf|tt|it|underscore|quotesingle)\b|\\(?:begin|end)\{[a-z]+\*?\}|\\lstinline|\\verb\b|(?<=\w)\\[_&%#](?=\w)")
_CODE_WIKI = re.compile(r"</?(?:nowiki|syntaxhighlight|source)\b[^>]*>", re.I)


def kinds_of_code(lang: str | None, content: str) -> set[str]:
    """The markups and escapes in a code block that are not its language's own."""
    name = (lang or "unknown").strip().lower()
    found = set()
    if name not in OWN_HTML and ("<" in content or "&" in content) and (_CODE_TAG.search(content) or _CODE_ENTITY.search(content)):
        found.add("html")
    if name not in OWN_LATEX and "\\" in content and _CODE_LATEX.search(content):
        found.add("latex")
    if name not in OWN_WIKI and "<" in content and _CODE_WIKI.search(content):
        found.add("wiki")
    return found


def clean_code(lang: str | None, content: str) -> str:
    """A code block without foreign markup and escapes."""
    kinds = kinds_of_code(lang, content)
    if "wiki" in kinds:
        content = _CODE_WIKI.sub("", content)
    if "html" in kinds:
        content = html.unescape(_CODE_TAG.sub(lambda m: "\n" if m[0].lower().startswith("<br") and m.end() < len(content) else "", content))
    if "latex" in kinds:
        content = re.sub(r"\\(?:begin|end)\{[a-z]+\*?\}\n?", "", content)
        for name, char in (("asciitilde", "~"), ("backslash", "\\"), ("asciicircum", "^"), ("underscore", "_"), ("quotesingle", "'")):
            content = re.sub(rf"\\text{name}(?:\{{\}})?", lambda _, c=char: c, content)
        content = re.sub(r"\\text(?:bf|tt|it)\{([^{}]*)\}", r"\1", content)
        content = re.sub(r"(?<=\w)\\([_&%#])(?=\w)", r"\1", content)
    return content


def clean_heading(text: str) -> str:
    """A heading's text without inline markup."""
    text = clean(text)
    text = re.sub(r"!?\[\[([^\]|\n]*\|)?([^\]\n]+)\]\]", r"\2", text)
    text = re.sub(r"!?\[([^\]\n]*)\]\([^)\n]*\)", r"\1", text)
    for mark in (r"\*\*", "__", "~~", "==", r"\*", "(?<!\\w)_(?!\\s)", "`"):
        text = re.sub(mark if mark.startswith("(") else rf"{mark}(\S(?:.*?\S)?){mark}", "" if mark.startswith("(") else r"\1", text)
    return re.sub(r"\s+", " ", text).strip()


def _general(name: str, attributes: str) -> str:
    """A tag with its class, digits and separators generalised."""
    m = _ATTR_CLASS.search(attributes)
    return name + ("." + re.sub(r"\d+", "0", m[1].lower()) if m else "")


def containers(text: str) -> list[tuple[str, int, int]]:
    """(generalised path, words, words of links and scripts) of each container."""
    shown = masked(text)
    open_: list[list] = []
    out = []
    at = 0

    def add(words: str, bad: bool) -> None:
        n = len(words.split())
        for c in open_:
            c[1] += n
            c[2] += n if bad else 0

    for b, e, _, kind, m in tokens(shown):
        if b < at:
            continue
        add(text[at:b], any(c[0].rsplit(">")[-1].split(".")[0] in ("a", "script", "style") for c in open_))
        at = e
        if kind == "tag":
            name = m[2].lower()
            if m[1]:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][3] == name:
                        out += [tuple(c[:3]) for c in open_[k:]]
                        del open_[k:]
                        break
            elif name not in VOID and not m[4]:
                prefix = open_[-1][0] + ">" if open_ and len(open_) < 6 else ""
                open_.append([prefix + _general(name, m[3]), 0, 0, name])
        elif kind == "env":
            name = m["name"]
            if m["env"] == "begin":
                open_.append(["env:" + name, 0, 0, name])
            else:
                for k in range(len(open_) - 1, -1, -1):
                    if open_[k][3] == name:
                        out += [tuple(c[:3]) for c in open_[k:]]
                        del open_[k:]
                        break
        elif kind == "template":
            out.append(("template:" + re.split(r"[|}\n]", m[0][2:])[0].strip().lower()[:40], 0, len(m[0].split())))
    add(text[at:], False)
    return [*out, *(tuple(c[:3]) for c in open_)]


def _braced(text: str, at: int) -> int:
    """Where the brace that opens before ``at`` closes, or the text's end."""
    depth = 1
    while at < len(text):
        c = text[at]
        if c == "\\":
            at += 1
        elif c == "{":
            depth += 1
        elif c == "}":
            depth -= 1
            if not depth:
                return at
        at += 1
    return len(text)


def clean(text: str, losing: frozenset[str] = frozenset()) -> str:
    """The text in the notes' own form; containers on losing paths are left out."""
    return extract(text, losing)[0]


def extract(text: str, losing: frozenset[str] = frozenset()) -> tuple[str, set[str]]:
    """The text in the notes' own form without containers on losing paths, and the markups that were rewritten or left out."""
    shown = masked(text)
    found = tokens(shown)
    if not found:
        return text, set()
    out: list[str] = []
    at, skip_to, ordered, code = 0, 0, [], 0
    closing: dict[int, str] = {}
    path: list[str] = []

    def put(upto: int) -> None:
        nonlocal at
        while closing and (k := min(closing)) < upto:
            if k >= at:
                out.append(text[at:k])
                out.append(closing.pop(k))
                at = k + 1
            else:
                closing.pop(k)
        if upto > at:
            out.append(text[at:upto])
            at = upto

    for i, (b, e, markup, kind, m) in enumerate(found):
        if b < skip_to:
            continue
        put(b)
        if at > e:
            continue
        at = max(at, e)
        if kind == "comment" or kind in ("magic", "redirect"):
            continue
        if kind == "entity":
            c = html.unescape(m[0])
            out.append(" " if c == "\u00a0" else c)
        elif kind == "tag":
            name, close = m[2].lower(), bool(m[1])
            spot = _general(name, m[3])
            full = (path[-1] + ">" if path and len(path) < 6 else "") + spot
            if not close and not m[4] and name not in VOID and (name in DROPPED or full in losing):
                end = next((t for t in found[i + 1 :] if t[3] == "tag" and t[4][1] and t[4][2].lower() == name), None)
                skip_to = at = end[1] if end else e
                continue
            if name not in VOID and not m[4]:
                if close:
                    for k in range(len(path) - 1, -1, -1):
                        if path[k].rsplit(">", 1)[-1].split(".")[0] == name:
                            del path[k:]
                            break
                else:
                    path.append(full)
            if len(name) == 2 and name[0] == "h" and name[1].isdigit():
                out.append("\n\n" if close else "\n\n" + "#" * int(name[1]) + " ")
            elif name in ("ul", "ol"):
                (ordered.pop() if ordered else None) if close else ordered.append([name, 0])
                out.append("\n")
            elif name == "li":
                if not close:
                    if ordered and ordered[-1][0] == "ol":
                        ordered[-1][1] += 1
                        out.append(f"\n{ordered[-1][1]}. ")
                    else:
                        out.append("\n- ")
            elif name == "pre":
                code += -1 if close else 1
                out.append("\n```\n" if not close else "\n```\n")
            elif name == "code":
                out.append("" if code else "`")
            elif name in ("td", "th"):
                out.append(" |" if close else " ")
            elif name == "tr":
                out.append("" if close else "\n|")
            elif name == "blockquote":
                out.append("\n\n" if close else "\n\n> ")
            elif name in ("p", "div", "br", "hr", "table", "section", "article", "details", "summary", "center"):
                out.append("\n\n" if name == "p" else "\n")
        elif kind == "head":
            bare = m[0].strip()
            level = min(len(bare) - len(bare.lstrip("=")), 6)
            out.append("#" * level + " " + bare.strip("=").strip())
        elif kind == "bold":
            out.append(clean(m[0].strip("'"), losing))
        elif kind == "template":
            name = "template:" + re.split(r"[|}\n]", m[0][2:])[0].strip().lower()[:40]
            values = [p.split("=")[-1].strip() for p in m[0][2:-2].split("|")[1:]]
            if name not in losing and values:
                out.append(", ".join(v for v in values if v))
        elif kind == "file":
            parts = m[0][2:-2].split("|")
            out.append(clean(parts[-1], losing) if len(parts) > 1 else "")
        elif kind == "link":
            out.append(m[0][1:-1].partition(" ")[2].strip())
        elif kind == "table":
            end = shown.find("\n", b)
            skip_to = at = len(text) if end < 0 else end
        elif kind == "row":
            pass
        elif kind == "env":
            name = m["name"]
            if name in ("verbatim", "lstlisting", "minted"):
                out.append("\n```\n")
            elif name.rstrip("*") in ("equation", "align", "displaymath", "math"):
                out.append("$$")
        elif kind == "cmd":
            name = m["cmd"]
            if not m["brace"]:
                out.append("- " if name == "item" else name if name in ("LaTeX", "TeX") else "")
                if name == "item":
                    while at < len(text) and text[at] == " ":
                        at += 1
                continue
            end = _braced(text, e)
            if name in SILENT:
                skip_to = at = min(len(text), end + 1)
            elif name in HEADINGS:
                out.append("#" * HEADINGS[name] + " ")
                closing[end] = ""
            elif name in ("footnote", "footnotetext"):
                out.append(" (")
                closing[end] = ")"
            elif name == "texttt":
                out.append("`")
                closing[end] = "`"
            else:
                if name in ("LaTeX", "TeX"):
                    out.append(name)
                closing[end] = ""
    put(len(text))
    done = "".join(out)
    done = re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", done))
    return done.strip("\n") if "\n" in text else done.strip(), {t[2] for t in found}


FOUND = "doc_id string, field string, markup string"


def _found_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = set()
        for doc, headings, codes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for h in headings or ():
                if h:
                    out |= {(doc, "headings", k) for k in kinds_of_heading(h)}
            for c in codes or ():
                if c and c["content"]:
                    out |= {(doc, "code_blocks", k) for k in kinds_of_code(c["lang"], c["content"])}
        if out:
            a, b, c = zip(*sorted(out), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b), pa.array(c)], ["doc_id", "field", "markup"])


#: What a text must hold to have any markup; the rest stays in the JVM.
_SIGNS = r"[<&\\]|''|\{\{|(^|\n)[ \t]*=|\[\[|\[(http|ftp)|__[A-Z]|(^|\n)[ \t]*(\{\||\|\})|#(REDIRECT|WEITERLEITUNG)"


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
            for path, words, bad in containers(text):
                t = total[path]
                t[0] += 1
                t[1] += words
                t[2] += bad
            rows += [(doc, k, *v) for k, v in total.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "path", "votes", "words", "other"])


#: Containers of a host that a path needs before it can lose.
LEAST_VOTES = 5


def votes(scores: DataFrame) -> DataFrame:
    """(host, path, votes, words, other, content): what each host's texts say of a container path."""
    by = scores.groupBy("host", "path").agg(*(F.sum(c).alias(c) for c in ("votes", "words", "other")))
    return by.withColumn("content", F.col("words") > 2 * F.col("other"))


def losing_paths(marked: DataFrame, hosts: DataFrame, least_votes: int = LEAST_VOTES) -> DataFrame:
    """(doc_id, losing): the paths in a text of (doc_id, text) that the texts of its host (doc_id, host) vote out."""
    scored = marked.mapInArrow(_scores, "doc_id string, path string, votes bigint, words bigint, other bigint").distinct()
    scored = keep(scored.join(hosts, "doc_id", "left").withColumn("host", F.coalesce("host", F.lit(""))))
    lost = votes(scored).where(f"not content and votes >= {least_votes}").select("host", "path")
    return keep(scored.join(lost, ["host", "path"], "left_semi").groupBy("doc_id").agg(F.sort_array(F.collect_set("path")).alias("losing")))  # paths of one text


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [extract(t, frozenset(lost or ())) for t, lost in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in made], pa.string()), pa.array([sorted(k) for _, k in made], pa.list_(pa.string()))], ["doc_id", "text", "markups"])


def _marked(texts: DataFrame) -> DataFrame:
    return texts.where(F.col("text").rlike(_SIGNS))


def extracted(texts: DataFrame, hosts: DataFrame) -> DataFrame:
    """(doc_id, text, markups) of the texts (doc_id, text) with signs of markup, extracted with each host's winning paths."""
    ship(texts.sparkSession)
    marked = _marked(texts)
    return marked.join(losing_paths(marked, hosts), "doc_id", "left").select("doc_id", "text", "losing").mapInArrow(_extracted, "doc_id string, text string, markups array<string>")


def clean_texts(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(doc_id, text): the texts in the notes' own form, extracted with each host's winning paths."""
    texts = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    hosts = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("string").alias("doc_id")).agg(F.min(host_col).alias("host"))
    plain = texts.where(F.coalesce(~F.col("text").rlike(_SIGNS), F.lit(True)))
    return plain.unionByName(extracted(texts, hosts).select("doc_id", "text"))


def found(bodies: DataFrame, hosts: DataFrame, structured: DataFrame) -> DataFrame:
    """(doc_id, field, markup) of markup left in bodies (doc_id, text), headings and code blocks."""
    inline = F.filter(F.transform("headings", lambda h: h["text"]), lambda t: t.rlike(r"[<&\\*_`~\[]|''|\{\{|=="))
    codes = F.filter("code_blocks", lambda c: c["content"].rlike(r"[<&\\]"))
    parts = structured.select("doc_id", inline.alias("headings"), codes.alias("code_blocks")).where("doc_id is not null and (size(headings) > 0 or size(code_blocks) > 0)")
    rows = extracted(bodies, hosts).select("doc_id", F.lit("body").alias("field"), F.explode("markups").alias("markup"))
    return rows.unionByName(parts.mapInArrow(_found_parts, FOUND)).distinct()


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "manifest").where("doc_id is not null").groupBy("doc_id").agg(F.substring_index(F.min("path"), "/", 1).alias("host"))


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "cleaned").where("doc_id is not null").select("doc_id", F.col("body").alias("text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, field, markup) of left-over markup in bodies, headings and code blocks."""
    return found(_bodies(spark, sf_dir), _hosts(spark, sf_dir), table(spark, sf_dir, "structured"))


def p5_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every body as clean text, by its digest and size."""
    bodies, hosts = _bodies(spark, sf_dir), _hosts(spark, sf_dir)
    plain = bodies.where(F.coalesce(~F.col("text").rlike(_SIGNS), F.lit(True)))
    out = plain.unionByName(extracted(bodies, hosts).select("doc_id", "text"))
    return out.select("doc_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")).distinct()


def _parts_cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, headings, codes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            rows.append((doc, [{"level": h["level"], "text": clean_heading(h["text"]) if h["text"] else h["text"]} for h in headings or () if h], [{"lang": c["lang"], "content": clean_code(c["lang"], c["content"]) if c["content"] else c["content"]} for c in codes or () if c]))
        kinds = (pa.string(), pa.list_(pa.struct([("level", pa.int32()), ("text", pa.string())])), pa.list_(pa.struct([("lang", pa.string()), ("content", pa.string())])))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "headings", "code_blocks"])


def p5_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings and code blocks of every record without foreign markup."""
    ship(spark)
    rows = table(spark, sf_dir, "structured").select("doc_id", "headings", "code_blocks").where("doc_id is not null").dropDuplicates()
    return rows.mapInArrow(_parts_cleaner, "doc_id string, headings array<struct<level: int, text: string>>, code_blocks array<struct<lang: string, content: string>>")


QUERIES = {"p5_found": p5_found, "p5_texts": p5_texts, "p5_structure": p5_structure}
SQL: dict[str, str] = {}
