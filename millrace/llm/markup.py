"""Texts freed of HTML, Markdown, wiki and LaTeX markup, whole or in fragments, by consensus host paths.

1. ``containers`` scores the HTML containers of each page: its prose against its link text, by the path of its tags, with
   classes generalised (digits to 0), so that pages made from one template have the same paths.
2. ``losing_paths`` sums the scores of a path over all pages of a host in Spark, which is its vote: a path whose containers
   hold no prose, or more link text than prose, loses (menus, link lists, scripts); any other wins.
3. ``clean_text`` extracts the pages again, from the containers on winning paths, and converts them: headings become lines
   ``§level title``, list items ``- `` or ``1. ``, table cells are parted by tabs, code blocks are indented by four blanks,
   formulas are written in one line with Unicode signs. It also tells the kinds of markup that a text held.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator, Set

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import cut, spread, table, text_batches

#: Code of all kinds; what opens first wins, and only the delimiters count.
CODE = re.compile(
    r"^[ \t>]*(?P<fence>```+|~~~+)[^\n]*\n.*?^[ \t>]*(?P=fence)[ \t\r]*$"
    r"|(?P<wiki>\{(?P<w>code|noformat)(?:[:|][^}\n]*)?\}.*?\{(?P=w)\}|\{\{code\|.*?\}\}|\{\{(?=[^{}|\n]*\}\})[^{}\n]*\}\}|<(?P<n>nowiki|syntaxhighlight|source)\b[^>]*>.*?</(?P=n)>)"
    r"|(?P<html><(?P<h>pre|code|kbd|samp|script|style)\b[^>]*>.*?</(?P=h)>)"
    r"|(?P<latex>\\begin\{(?P<l>verbatim|lstlisting|minted)\}.*?\\end\{(?P=l)\}|\\texttt\{[^{}\n]*\}|\\verb(?P<v>[|!+]).*?(?P=v))"
    r"|(?P<ticks>`+)(?!`)[^\n]+?(?<!`)(?P=ticks)(?!`)",
    re.S | re.M | re.I,
)
TAGS = (
    "html|head|body|title|meta|link|div|span|p|br|hr|h[1-6]|ul|ol|li|dl|dt|dd|table|thead|tbody|tfoot|tr|td|th|caption|col|colgroup|pre|code|kbd|samp|tt|var|em|strong|small|big|sub|sup|"
    "font|center|img|figure|figcaption|blockquote|cite|del|ins|mark|abbr|section|article|header|footer|nav|main|aside|details|summary|script|style|iframe|form|input|button|label|select|option|textarea|video|audio|svg|a|b|i|u|s|q"
)
HTML = re.compile(
    rf"</?(?:{TAGS})\s*/?>|</?(?:{TAGS})\s+[a-z-]+\s*=|</(?:{TAGS})\b|<(?:div|span|table|font|img|blockquote)\b|<!--|-->|<!doctype"
    r"|&(?:#\d{1,6}|#x[0-9a-f]{1,6}|nbsp|lt|gt|amp|quot|apos|copy|reg|trade|mdash|ndash|hellip|laquo|raquo|ldquo|rdquo|lsquo|rsquo|bull|middot|times|deg|euro|[aouAOU]uml|szlig|[aeioun](?:acute|grave|circ|tilde));",
    re.I,
)
MARKDOWN = re.compile(
    r"^[ \t﻿]{0,3}#{1,6}[ \t]+\S|(?<=[^\s|=-])[ \t\r]*\n[ \t]{0,3}(?:={3,}|-{3,})[ \t\r]*$|`|^[ \t]*~~~|(?<!~)~~(?=[^\s~])|(?<=[^\s~])~~(?!~)"
    r"|(?<!\*)\*\*(?=[^\s*\d])|(?<=[^\s*\d])\*\*(?!\*)|(?<![A-Za-z0-9_])__(?!(?:init|main|name|all|file|doc|dict|class|call|str|repr|version|pycache)__)(?=[^\s_])[^_\n]+(?:_[^_\n]+)*__(?![A-Za-z0-9_.])"
    r"|!?\[[^\]\n]*\]\([^)\s]+|^[ \t﻿]{0,3}>[ \t]+\S|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t\r]*$|^[ \t]*[-*+] \[[ xX]\] ",
    re.M,
)
WIKI = re.compile(
    r"(?<!')'{2,3}(?=[^\s'])|(?<=[^\s'])'{2,3}(?!')|\[\[(?=[^\s\[])|(?<=[^\s\]])\]\]|\{\{(?=[^\s{}]*[|}\w/])(?<![A-Za-z_^}]\{\{)|^[ \t﻿]*={2,6}[ \t]*[^=\s][^\n]*?={2,6}[ \t\r]*$|^[ \t﻿]*h[1-6]\.[ \t]"
    r"|\{/?(?:color|info|code|warning|note|tip|panel|quote|noformat|toc|expand)(?:[:|][^{}\n]*)?\}|^[ \t]*\{\||^[ \t]*\|\}|^[ \t]*\|-[ \t\r]*$|^[ \t]*\|\|[^|\n]+\|\|"
    r"|\[https?://[^\s\]|]+[ |][^\]\n]*\]|\[[^\]|\n]+\|https?://|</?(?:nowiki|ref|syntaxhighlight)\b",
    re.M | re.I,
)
_COMMANDS = (
    "begin|end|item|section|subsection|subsubsection|paragraph|chapter|emph|textbf|textit|texttt|underline|cite|ref|label|caption|includegraphics|usepackage|documentclass|footnote|hline|centering|url|href|verb|"
    "frac|sqrt|sum|prod|int|lim|le|leq|ge|geq|ne|neq|cdot|times|approx|infty|partial|left|right|text|mathrm|mathbf|alpha|beta|gamma|delta|epsilon|theta|lambda|mu|nu|pi|rho|sigma|tau|phi|psi|omega|Delta|Sigma|Omega|ldots|dots|quad|log|min|max"
)
LATEX = re.compile(
    rf"(?<![A-Za-z0-9:.-])\\(?:{_COMMANDS})(?![A-Za-z\\])|\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{{|\\_(?=\w)|(?<=\s)\\\\[ \t\r]*$|\\\((?=\s)|(?<=\s)\\\)|^\\\[|\\\][ \t\r]*$"
    r"|\$\$|\$[^$\n]*(?:\\[A-Za-z]|[\^_]\{|[A-Za-z]_[A-Za-z0-9])[^$\n]*\$|[A-Za-z]_\{\w+\}|\^\{\w+\}",
    re.M,
)
KINDS = (("html", HTML), ("markdown", MARKDOWN), ("wiki", WIKI), ("latex", LATEX))


_SET = frozenset(TAGS.replace("h[1-6]", "h1|h2|h3|h4|h5|h6").split("|"))
_TAG = re.compile(r"<!--.*?-->|<!--|-->|<!doctype[^<>]*>|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9]*)(?P<rest>(?:\s[^<>]*)?)/?>", re.S | re.I)
_CLASS = re.compile(r"""\bclass\s*=\s*["']?([A-Za-z0-9_-]+)""", re.I)
#: Elements without an end tag, and those that begin a line.
_VOID = frozenset(("br", "hr", "img", "meta", "link", "input", "col"))
_LINES = frozenset("p div section article header footer nav main aside details summary blockquote table thead tbody tfoot tr ul ol dl dt dd figure figcaption form hr br center caption".split())
#: Containers of the deepest DEPTH levels make a path.
DEPTH = 4
_STILL = "\ue0f0{}\ue0f1"
_KEPT = re.compile("\ue0f0(\\d+)\ue0f1")
#: TeX commands and the signs they stand for.
SIGNS = {
    "alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ", "epsilon": "ε", "theta": "θ", "lambda": "λ", "mu": "μ", "nu": "ν", "pi": "π", "rho": "ρ", "sigma": "σ", "tau": "τ", "phi": "φ", "psi": "ψ", "omega": "ω",
    "Delta": "Δ", "Sigma": "Σ", "Omega": "Ω", "sum": "∑", "prod": "∏", "int": "∫", "partial": "∂", "infty": "∞", "le": "≤", "leq": "≤", "ge": "≥", "geq": "≥", "ne": "≠", "neq": "≠", "cdot": "·", "times": "×", "approx": "≈",
    "ldots": "…", "dots": "…", "quad": " ", "left": "", "right": "", "log": "log", "min": "min", "max": "max", "lim": "lim",
}


def _path(stack: list[str]) -> str:
    return "/".join(stack[-DEPTH:])


def _walk(text: str, stack: list[str], on_text: Callable[[str, str], None], on_tag: Callable[[str, bool], None]) -> None:
    """The text between the tags of a page, each with its path; end tags without a start are tags too, unknown ones are text."""
    at = 0
    for m in _TAG.finditer(text):
        tag = (m["tag"] or "").lower()
        if m["tag"] and tag not in _SET:
            continue
        if m.start() > at:
            on_text(text[at : m.start()], _path(stack))
        at = m.end()
        if not tag:
            continue
        if m["end"]:
            where = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].split(".")[0] == tag), -1)
            if where >= 0:
                del stack[where:]
        on_tag(tag, bool(m["end"]))
        if not m["end"] and tag not in _VOID:
            c = _CLASS.search(m["rest"] or "")
            if tag in ("li", "p", "td", "th", "tr") and stack and stack[-1].split(".")[0] == tag:
                stack.pop()  # its end tag was left out
            stack.append(f"{tag}.{re.sub(r'[0-9]+', '0', c[1].lower())}" if c else tag)
    if at < len(text):
        on_text(text[at:], _path(stack))


def containers(text: str | None) -> dict[str, list[int]]:
    """Prose and link characters of each container path of a page; empty where there is no tag. Code counts as prose."""
    found: dict[str, list[int]] = {}
    if not text or "<" not in text or not HTML.search(text):
        return found

    def on_text(t: str, path: str) -> None:
        if path:
            score = found.setdefault(path, [0, 0])
            steps = [s.split(".")[0] for s in path.split("/")]
            if "script" not in steps and "style" not in steps:
                score["a" in steps or "nav" in steps] += sum(c.isalnum() for c in t)

    _walk(text, [], on_text, lambda tag, end: None)
    return found


def _from_html(text: str, losing: Set[str]) -> str:
    out: list[str] = []
    lists: list[int] = []  # of each open list the last number; -1 for one without numbers
    cells = [0]

    def on_text(t: str, path: str) -> None:
        if path not in losing:
            out.append(t)

    def on_tag(tag: str, end: bool) -> None:
        if tag in ("ul", "ol"):
            if not end:
                lists.append(0 if tag == "ol" else -1)
            elif lists:
                lists.pop()
        if tag[0] == "h" and tag[1:].isdigit():
            out.append("\n\n" if end else f"\n\n§{tag[1:]} ")
        elif tag == "li" and not end:
            if lists and lists[-1] >= 0:
                lists[-1] += 1
            out.append(f"\n{lists[-1]}. " if lists and lists[-1] > 0 else "\n- ")
        elif tag in ("td", "th"):
            if not end:
                out.append("\t" if cells[0] else "")
                cells[0] += 1
        elif tag in _LINES:
            cells[0] = 0 if tag == "tr" else cells[0]
            out.append("\n")

    _walk(text, [], on_text, on_tag)
    joined = re.sub(rf"</(?:{TAGS})\b|<(?:div|span|table|font|img|blockquote)\b[^<>\n]*", "", "".join(out), flags=re.I)
    return entities.unescape(entities.unescape(joined)).replace("\xa0", " ")


_ARG = r"(?:\[[^\]\n]*\])?\{([^{}]*)\}"


def _from_latex(text: str) -> str:
    numbers: list[int] = []

    def listing(m: re.Match) -> str:
        if m[1] == "begin":
            numbers.append(0 if m[2] == "enumerate" else -1)
        elif m[1] == "end" and numbers:
            numbers.pop()
        elif m[3]:
            if numbers and numbers[-1] >= 0:
                numbers[-1] += 1
                return f"\n{numbers[-1]}. "
            return "\n- "
        return "\n"

    t = re.sub(r"\\(?:(begin|end)\{(itemize|enumerate|description)\}|(item)(?![A-Za-z])(?:\[[^\]\n]*\])?[ \t]*)", listing, text)
    t = re.sub(r"\\((?:sub)*)section\*?" + _ARG, lambda m: f"\n\n§{1 + len(m[1]) // 3} {m[2]}\n", t)
    t = re.sub(r"\\(?:chapter|paragraph)\*?" + _ARG, r"\n\n§1 \1\n", t)
    t = re.sub(r"\\begin\{tabular\*?\}(?:\{[^{}]*\})?(.*?)\\end\{tabular\*?\}", lambda m: m[1].replace("&", "\t").replace("\\hline", ""), t, flags=re.S)
    t = re.sub(r"\\(?:begin|end)\{[^{}\n]*\}|\\hline(?![A-Za-z])|\\centering(?![A-Za-z])", "\n", t)
    t = re.sub(r"\\([_%&#$])", r"\1", t)
    t = re.sub(r"\$\$|\\\(|\\\)|\\\[|\\\]", " ", t)
    t = re.sub(r"\$([^$\n]*(?:\\[A-Za-z]|[\^_]\{|[A-Za-z]_[A-Za-z0-9])[^$\n]*)\$", r"\1", t)
    for _ in range(16):  # from within to without, as deep as braces are nested
        before = t
        t = re.sub(r"([_^])\{([^{}]*)\}", lambda m: m[1] + (m[2] if len(m[2]) < 2 or m[2].isalnum() else f"({m[2]})"), t)
        t = re.sub(r"\\sqrt" + _ARG, r"√(\1)", t)
        t = re.sub(r"\\frac\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", t)
        t = re.sub(r"\\(?:ref|label|cite|usepackage|documentclass|includegraphics)" + _ARG, r"[\1]", t)
        t = re.sub(r"\\href\{([^{}]*)\}\s*\{([^{}]*)\}", r"\2 (\1)", t)
        t = re.sub(r"\\[A-Za-z]+\*?" + _ARG, r"\1", t)
        if t == before:
            break
    t = re.sub(rf"(?<![A-Za-z0-9:.-])\\({_COMMANDS})(?![A-Za-z\\])", lambda m: SIGNS.get(m[1], " "), t)
    return re.sub(r"(?<=\s)\\\\[ \t]*(?=\r?$)", "", t, flags=re.M)


def _from_wiki(text: str) -> str:
    t = re.sub(r"^[ \t\ufeff]*(={2,6})[ \t]*([^=\s][^\n]*?)={2,6}[ \t]*(?=\r?$)", lambda m: f"\n§{len(m[1])} {m[2].rstrip()}\n", text, flags=re.M)
    t = re.sub(r"^[ \t\ufeff]*h([1-6])\.[ \t]+", r"§\1 ", t, flags=re.M)
    t = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]+)\]\]", r"\1", t)
    t = re.sub(r"\[(https?://[^\s\]|]+)[ |]([^\]\n]*)\]", r"\2 (\1)", t)
    t = re.sub(r"\[([^\]|\n]+)\|(https?://[^\]\s]+)\]", r"\1 (\2)", t)
    t = re.sub(r"\{\{([^{}\n]*)\}\}", lambda m: " ".join(x.strip() for x in m[1].split("|")), t)
    t = re.sub(r"\{/?(?:color|info|code|warning|note|tip|panel|quote|noformat|toc|expand)(?:[:|][^{}\n]*)?\}|</?(?:nowiki|ref|syntaxhighlight)\b[^<>\n]*>?", "", t, flags=re.I)
    t = re.sub(r"^[ \t]*(?:\{\|[^\n]*|\|\}|\|-)[ \t]*(?:\r?\n|$)", "", t, flags=re.M)
    t = re.sub(r"^[ \t]*\|\|([^|\n]+(?:\|\|[^|\n]+)*)(?:\|\|)?[ \t]*(?=\r?$)", lambda m: "\t".join(x.strip() for x in m[1].split("||")), t, flags=re.M)
    t = re.sub(r"^[ \t]*[|!][ \t]+(\S[^\n]*)$", lambda m: "\t".join(x.strip() for x in re.split(r"\|\||!!", m[1])), t, flags=re.M)
    t = re.sub(r"(?<!')'{2,3}(?=[^\s'])|(?<=[^\s'])'{2,3}(?!')", "", t)
    return re.sub(r"\[\[(?=[^\s\[])|(?<=[^\s\]])\]\]|\{\{(?=[^\s{}])(?<![A-Za-z_^}]\{\{)", "", t)


def _row(m: re.Match) -> str:
    line = m[0].strip()
    if re.fullmatch(r"\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?", line):
        return ""
    return "\t".join(x.strip() for x in line.strip("|").split("|"))


def _from_markdown(text: str) -> str:
    t = re.sub(r"^([^\n|]*\S)[ \t]*\r?\n[ \t]{0,3}(={3,}|-{3,})[ \t]*(?=\r?$)", lambda m: f"\n§{1 if m[2][0] == '=' else 2} {m[1]}\n", text, flags=re.M)
    t = re.sub(r"^[ \t\ufeff]{0,3}(#{1,6})[ \t]+(\S[^\n]*?)[ \t]*#*[ \t]*(?=\r?$)", lambda m: f"§{len(m[1])} {m[2]}", t, flags=re.M)
    if "---" in t:
        t = re.sub(r"^[ \t]*\|[^\n]*\|[ \t]*(?=\r?$)", _row, t, flags=re.M)
        t = re.sub(r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*(?:\r?\n|$)", "", t, flags=re.M)
    t = re.sub(r"!\[([^\]\n]*)\]\([^)\n]*\)?", r"\1", t)
    t = re.sub(r"\[([^\]\n]*)\]\(([^)\s]+)[^)\n]*\)?", r"\1 (\2)", t)
    t = re.sub(r"^[ \t\ufeff]{0,3}(?:>[ \t]*)+(?=\S)", "", t, flags=re.M)
    t = re.sub(r"^([ \t]*)[-*+] \[[ xX]\] ", r"\1- ", t, flags=re.M)
    t = re.sub(r"(?<![A-Za-z0-9_])__(?=[^\s_])([^_\n]+(?:_[^_\n]+)*)__(?![A-Za-z0-9_.])", r"\1", t)
    t = re.sub(r"(?<!\*)\*\*(?=[^\s*\d])|(?<=[^\s*\d])\*\*(?!\*)|(?<!~)~~(?=[^\s~])|(?<=[^\s~])~~(?!~)", "", t)
    return re.sub(r"^[ \t]*(?:~~~|```)[^\n]*|`", "", t, flags=re.M)


_CONVERT = {"wiki": _from_wiki, "latex": _from_latex, "markdown": _from_markdown}
_INNER = re.compile(
    r"^[ \t>]*(?:```+|~~~+)[^\n]*\n(?P<a>.*?)\n?[ \t>]*(?:```+|~~~+)[ \t\r]*$|^\{(?:code|noformat)[^}\n]*\}(?P<b>.*?)\{(?:code|noformat)\}$|^\{\{(?:code\|)?(?P<c>.*?)\}\}$"
    r"|^\\begin\{(?:verbatim|lstlisting|minted)\}(?P<d>.*?)\\end\{\w+\}$|^\\texttt\{(?P<e>.*)\}$|^\\verb.(?P<f>.*).$|^<\w+[^>]*>(?P<g>.*?)</\w+>$|^`+(?P<h>.*?)`+$",
    re.S | re.I,
)


def convert(text: str | None, losing: Set[str] = frozenset()) -> tuple[str | None, list[str]]:
    """The clean text and the kinds of markup that the text held, sorted.

    A text without markup, an empty or null one comes back as it is. What stands inside code is kept as it is and is no
    case, its delimiters are. ``losing`` are container paths whose text is left out.
    """
    if not text:
        return text, []
    found: set[str] = set()
    codes: list[str] = []

    def code(m: re.Match) -> str:
        kind = "markdown" if m["fence"] or m["ticks"] else next(k for k in ("wiki", "html", "latex") if m[k])
        found.add(kind)
        if kind == "html" and m["h"].lower() in ("script", "style"):
            return "  "
        inner = _INNER.match(m[0].strip())
        body = next((g for g in inner.groups() if g is not None), "") if inner else m[0]
        if kind == "html":
            body = entities.unescape(re.sub(r"</?code\b[^>]*>", "", body, flags=re.I))
        if kind == "latex":
            body = re.sub(r"\\([_%&#$])", r"\1", body)
        codes.append("\n" + "\n".join("    " + x for x in body.strip("\r\n").splitlines()) + "\n" if "\n" in body or m["fence"] else body)
        return _STILL.format(len(codes) - 1)

    rest = CODE.sub(code, text)
    bare = _KEPT.sub("  ", rest) if codes else rest
    found.update(kind for kind, pattern in KINDS if kind not in found and pattern.search(bare))
    if not found:
        return text, []
    if "html" in found:
        rest = _from_html(rest, losing)
    for kind, turn in _CONVERT.items():
        if kind in found:
            rest = turn(rest)
    rest = _KEPT.sub(lambda m: codes[int(m[1])] if int(m[1]) < len(codes) else m[0], rest)
    return re.sub(r"\n(?:[ \t\r]*\n){2,}", "\n\n", rest).strip("\n"), sorted(found)


def kinds(text: str | None) -> list[tuple[str]]:
    """Kinds of markup in a text, sorted."""
    return [(k,) for k in convert(text)[1]]


# --- Spark ---


def losing_paths(pages: DataFrame, host: str, text: str) -> DataFrame:
    """host, losing (array of paths): the container paths that lose the vote of their host; one row for each host that has any.

    Scores are summed within each task and then by host and path, so a host with a third of all pages is summed like any.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: dict[tuple, list[int]] = {}
            for h, t in zip(b.column("host").to_pylist(), b.column("text").to_pylist()):
                for path, (prose, links) in containers(t).items():
                    s = total.setdefault((h, path), [0, 0])
                    s[0], s[1] = s[0] + prose, s[1] + links
            if total:
                hosts, paths = zip(*total)
                prose, links = zip(*total.values())
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths), pa.array(prose, pa.int64()), pa.array(links, pa.int64())], names=["host", "path", "prose", "links"])

    tagged = pages.select(F.col(host).cast("string").alias("host"), F.col(text).alias("text")).where(F.col("text").contains("<"))
    votes = spread(tagged).mapInArrow(score, "host string, path string, prose long, links long").groupBy("host", "path").agg(F.sum("prose").alias("prose"), F.sum("links").alias("links"))
    return votes.where("prose = 0 or links > prose").groupBy("host").agg(F.collect_set("path").alias("losing"))


def clean_text(df: DataFrame, keys: list[str], text: str, host: str | None = None) -> DataFrame:
    """``keys``, clean, kinds (array<string>) of every row of ``df``; other columns are ignored, repeated rows stay.

    ``host`` names the column whose equal values share templates; rows without a host (null) vote together. A null text gives
    null and no kinds, an empty one the empty text. The paths that lost are few; they are written and joined, by broadcast
    only where Spark knows them to be below its limit of size.
    """
    text_batches(df.sparkSession)
    pages = df.select(*keys, (F.coalesce(F.col(host).cast("string"), F.lit("")) if host else F.lit("")).alias("_host"), F.col(text).cast("string").alias("_text"))
    losing = cut(losing_paths(pages, "_host", "_text"), "paths").withColumnRenamed("host", "_host")
    both = spread(pages).join(losing, "_host", "left").select(*keys, "_text", "losing")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema), "clean string, kinds array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [convert(t, frozenset(p or ())) for t, p in zip(b.column("_text").to_pylist(), b.column("losing").to_pylist())]
            clean, found = zip(*made) if made else ((), ())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keys), pa.array(clean, pa.string()), pa.array(found, pa.list_(pa.string()))], names=[*keys, "clean", "kinds"])

    return both.mapInArrow(run, schema)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("topic", r"^(.*?)__", 1).alias("host")  # the area that a document comes from
    sections = table(spark, sf_dir, "sections").select(F.lit("section").alias("src"), F.col("section_id").cast("long").alias("row_id"), host, F.col("body").alias("text"))
    sops = table(spark, sf_dir, "sop_units").select(F.lit("sop").alias("src"), F.col("sop_id").cast("long").alias("row_id"), host, F.col("markdown").alias("text"))
    return sections.unionByName(sops)


def p1_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, row_id, clean, kinds of every section and procedure."""
    return clean_text(_texts(spark, sf_dir), ["src", "row_id"], "text", "host")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of markup that the converter found and converted."""
    return p1_clean(spark, sf_dir).select("src", "row_id", F.explode("kinds").alias("markup"))
