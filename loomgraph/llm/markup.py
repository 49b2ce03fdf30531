"""Markup residue in text: minimum-cut labelling of markup cues, and conversion to clean structured text."""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("html", "markdown", "wiki", "latex")

#: Names of HTML elements (fixed values).
ELEMENTS = frozenset(
    "a abbr address article aside audio b blockquote body br button caption center cite code col colgroup dd del details div dl dt em "
    "figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav "
    "noscript ol option p pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td "
    "textarea tfoot th thead time title tr tt u ul var video".split()
)
#: Rows without any of these signs can't hold a cue; the test runs in the JVM before Python sees a row.
GATE = (
    r"<[/!a-zA-Z]|&#?\w+;|\*\S|~~\S|`|(?<!\w)_\S|\]\s?\(|\[\[|\{\{|\{\||''|\\[a-zA-Z\[(]|\$[^$]*[\\^_{]|"
    r"(?:^|\n)(?:#{1,6} |> |\|| ?:?-{3,}:? ?\||={2,}|-{3,}\s*(?:\n|$))"
)

#: (kind, cue, weight, pattern). The weight is the log-odds that a match is markup; a weak or negative one needs neighbours
#: that are. A match is one node of the graph. A span ends at a blank line or at its own signs, however long it is.
_CUES = [
    ("html", "comment", 4.0, r"<!--.*?-->"),
    ("html", "tag", 4.0, r"</?(?P<tag>[a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?/?>"),
    ("html", "doctype", 4.0, r"<!doctype[^<>]*>"),
    ("html", "cut tag", 2.0, r"<(?:a\s+href|img\s+src|div\s+\w+=|span\s+\w+=|p\s+\w+=)[^<>]*\Z"),
    ("html", "reference", 4.0, r"&(?P<ref>#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"),
    ("markdown", "fence", 4.0, r"^[ \t]*```[^\n`]*$|```"),
    ("markdown", "heading", 3.0, r"^#{2,6} +(?=\S)"),
    ("markdown", "number sign", -0.6, r"^# +(?=[^\s\[])"),
    ("markdown", "underline", 3.0, r"(?<=\S)\n(?:={3,}|-{3,})[ \t]*$"),
    ("markdown", "image", 4.0, r"!\[[^\]\[]*\]\s?\(\s*[^()\s]+\s*\)"),
    ("markdown", "link", 4.0, r"(?<!!)\[[^\]\[]+\]\(\s*[^()\s]+\s*\)|(?<!!)\[[^\]\[]+\]\s\(\s*https?://[^()\s]+\s*\)"),
    ("markdown", "bold", 3.0, r"(?<!\*)\*\*(?=[^\s*])(?:[^*\n]|\n(?![^\S\n]*\n))+?(?<=[^\s*])\*\*(?!\*)"),
    ("markdown", "italic", 1.5, r"(?<![\w*])\*(?=[^\s*])(?:[^*\n]|\n(?![^\S\n]*\n))+?(?<=[^\s*])\*(?![\w*])"),
    ("markdown", "underlined", 2.5, r"(?<![\w_])__(?=[^\s_])(?:[^_\n]|\n(?![^\S\n]*\n))+?(?<=[^\s_])__(?![\w_])"),
    ("markdown", "emphasis", 1.0, r"(?<![\w_])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![\w_])"),
    ("markdown", "struck", 3.0, r"(?<!~)~~(?=[^\s~])(?:[^~\n]|\n(?![^\S\n]*\n))+?(?<=[^\s~])~~(?!~)"),
    ("markdown", "code", 2.5, r"(?<!`)`(?=[^\s`])(?:[^`\n]|\n(?![^\S\n]*\n))+?(?<=[^\s`])`(?!`)"),
    ("markdown", "table rule", 4.0, r"^\|? ?:?-{3,}:? ?(?:\| ?:?-{2,}:? ?)+\|?[ \t]*$"),
    ("markdown", "table row", -0.3, r"^\|(?![|}\-+])[^\n|=]*\|(?!\|)[^\n|]*\|[ \t]*$"),
    ("markdown", "quote", 1.2, r"^> +(?=[^\d\s])"),
    ("markdown", "quote line", -0.4, r"^>[ \t]*(?:\d[^\n]*)?$"),
    ("markdown", "item", -0.8, r"^[ \t]*(?:[-+]|\d{1,3}\.) +(?=\S)"),
    ("wiki", "link", 4.0, r"\[\[[^\[\]]+\]\]"),
    ("wiki", "template", 4.0, r"\{\{[^{}]+\}\}|\{\{(?=[A-Z][a-z])|^\}\}"),
    ("wiki", "table", 3.5, r"^\{\|[^\n]*$|^\|\}(?=\s|$)"),
    ("wiki", "table line", 1.0, r"^\|-[ \t]*$|^\|[^\n|]*\|\|[^\n]*$|^\|\+[^\n]*$|^![^\n!]*!![^\n]*$"),
    ("wiki", "bold", 3.0, r"(?<![\w'])'''(?=[^\s'])(?:[^'\n]|\n(?![^\S\n]*\n))+?(?<=[^\s'])'''(?![\w'])"),
    ("wiki", "italic", 2.5, r"(?<![\w'])''(?=[^\s'])(?:[^'\n]|\n(?![^\S\n]*\n))+?(?<=[^\s'])''(?![\w'])"),
    ("wiki", "heading", 3.0, r"^(?P<eq>={2,6}) *(?=[^\s=])(?:[^=\n]|\n(?![^\S\n]*\n))+?(?<=[^\s=]) *(?P=eq)[ \t]*$"),
    ("wiki", "item", -0.6, r"^(?:[*#]+|[:;]+) +(?=\S)"),
    ("latex", "environment", 4.0, r"\\(?:begin|end)\{[a-zA-Z]+\*?\}"),
    ("latex", "command", 3.5, r"(?:(?<=\S)~)?(?<![:\w\\])\\(?:sub)*(?!begin|end)[a-zA-Z]{2,}\*?(?:\[[^\]\n]*\])?\{"),
    ("latex", "command after text", 3.0, r"(?<=[\w.~,;)])~?\\(?:cite|ref|footnote|label|url|href|eqref)\{"),
    ("latex", "item", 3.0, r"^[ \t]*\\item\b(?!\\)"),
    ("latex", "display", 3.0, r"(?<!\\)\\\[(?=(?:(?!\\\[)[^\n]|\n(?![^\S\n]*\n))+?\\\])|\\\]"),
    ("latex", "inline", 3.0, r"\\\((?=(?:(?!\\\()[^\n]|\n(?![^\S\n]*\n))+?\\\))"),
    ("latex", "formula", 3.0, r"(?<![\\$\w])\$\$?(?=[^\s$])[^$\n]*(?:\\[a-zA-Z,]+|[\^_]\{)[^$\n]*\$\$?(?!\w)"),
    ("latex", "short formula", 2.0, r"(?<![\\$\w])\$(?=[A-Za-z\\(])[^$\n ]{0,40}[\^_=][^$\n]{0,40}\$(?!\w)"),
    ("latex", "symbol", 1.0, r"(?<![:\w\\])\\(?:frac|sqrt|cdot|times|approx|alpha|beta|gamma|pi|rho|sum|int|leq|geq|ldots|mathrm|textit)\b"),
]
#: Cues that span a line in which others may stand.
_LINES = ("table line", "table row")
_SPACED = re.compile(r"[ \t]+$", re.M)

#: Smoothness: capacity between cues of one kind that follow each other at once; it halves with each REACH letters.
ADJACENT, REACH = 1.5, 200
#: Capacity between cues that belong together in the tree: a tag and its end, the lines of a list, quote, table or environment.
TREE = 2.0


def _compiled() -> list[tuple[str, str, float, re.Pattern]]:
    flags = {"comment": re.S | re.I, "doctype": re.I, "display": re.S, "inline": re.S}
    return [(k, c, w, re.compile(p, re.M | flags.get(c, 0))) for k, c, w, p in _CUES]


class Labeller:
    """Finds markup cues and labels them by a minimum cut."""

    def __init__(self) -> None:
        self.cues = _compiled()
        self.named = {x.rstrip(";") for x in html5 if x.endswith(";")}

    def nodes(self, text: str) -> dict[str, list[tuple[int, int, str, float, str]]]:
        """By kind, in order: (start, end, cue, weight, name), overlapping cues of a kind reduced to the strongest."""
        found: dict[str, list[tuple[int, int, str, float, str]]] = {}
        for kind, cue, weight, pattern in self.cues:
            for m in pattern.finditer(text):
                name, w = "", weight
                if cue == "tag":
                    name = m["tag"].lower()
                    if name not in ELEMENTS:
                        w = -2.0
                elif cue == "reference":
                    if m["ref"][0] != "#" and m["ref"] not in self.named:
                        continue
                found.setdefault(kind, []).append((m.start(), m.end(), cue, w, name))
        for kind, ns in found.items():
            ns.sort(key=lambda n: (n[0], -n[3]))
            kept, end = [], -1
            for n in ns:
                if n[0] >= end:
                    kept.append(n)
                    end = n[0] + 1 if n[2] in _LINES else n[1]
                elif n[3] > kept[-1][3]:
                    kept[-1] = n
                    end = n[1]
            found[kind] = kept
        return found

    def edges(self, kind: str, ns: list[tuple[int, int, str, float, str]], text: str) -> list[tuple[int, int, float]]:
        out = []
        opened: dict[str, list[int]] = {}
        for i, (start, end, cue, _, name) in enumerate(ns):
            if i:
                gap = max(0, start - ns[i - 1][1])
                c = ADJACENT * 0.5 ** (gap / REACH)
                if gap < REACH and text.count("\n", ns[i - 1][1], start) <= 1 and {cue, ns[i - 1][2]} & {"item", "table row", "table line", "quote", "quote line"}:
                    c += TREE  # lines of one list, table or quote
                if c > 0.01:
                    out.append((i - 1, i, c))
            if cue == "tag":
                if text[start + 1] == "/":
                    if opened.get(name):
                        out.append((opened[name].pop(), i, TREE))
                elif text[end - 2] != "/":
                    opened.setdefault(name, []).append(i)
            elif cue == "environment":
                name = text[text.index("{", start) : end]
                if text.startswith("\\end", start):
                    if opened.get(name):
                        out.append((opened[name].pop(), i, TREE))
                else:
                    opened.setdefault(name, []).append(i)
        return out

    def label(self, text: str) -> dict[str, list[tuple[int, int, str, float, str]]]:
        """By kind the cues on the markup side of the minimum cut; kinds without any are left out."""
        out = {}
        for kind, ns in self.nodes(text).items():
            weights = [n[3] for n in ns]
            if max(weights) <= 0:
                continue  # nothing pulls to the markup side
            side = range(len(ns)) if min(weights) >= 0 else minimum_cut(weights, self.edges(kind, ns, text))
            if kept := [ns[i] for i in side]:
                out[kind] = kept
        return out


def minimum_cut(weights: list[float], edges: list[tuple[int, int, float]]) -> list[int]:
    """Nodes that stay with the source in a minimum cut. A positive weight is the capacity from the source, a negative one that to
    the sink; edges (a, b, capacity) hold in both directions. Maximum flow by shortest augmenting paths with level graphs."""
    n = len(weights)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[float] = []
    of: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        of[a].append(len(to))
        to.append(b)
        cap.append(forth)
        of[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, w in enumerate(weights):
        if w > 0:
            add(source, i, w, 0.0)
        elif w < 0:
            add(i, sink, -w, 0.0)
    for a, b, c in edges:
        add(a, b, c, c)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in of[a]:
                if cap[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [i for i in range(n) if level[i] >= 0]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= least
                    cap[e ^ 1] += least
                path, a = [], source
            while turn[a] < len(of[a]):
                e = of[a][turn[a]]
                if cap[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                turn[a] += 1
                continue
            path.append(e)
            a = to[e]


def _rows(text: str) -> str:
    cells = [c.strip() for c in re.split(r"\|\|?", text.strip().strip("|"))]
    return "| " + " | ".join(cells) + " |"


#: Signs that a conversion may start at.
_SIGNS = frozenset("*_~`>#|=<&[{'\\$!:;")
#: Stretches of 128 code points for private use; a text needs one that it doesn't use itself.
_PRIVATE = (range(0xE000 >> 7, 0xF900 >> 7), range(0xF0000 >> 7, 0x10FF80 >> 7))


def hidden(text: str, labelled: dict[str, list[tuple[int, int, str, float, str]]]) -> tuple[str, dict[int, str]]:
    """Text whose signs outside the labelled spans are private code points, which no conversion knows, and the way back."""
    used = {ord(c) >> 7 for c in text if c >= "\ue000"} if max(text, default="") >= "\ue000" else set()
    free = next((b for blocks in _PRIVATE for b in blocks if b not in used), None)
    if free is None:
        return text, {}  # no stretch is free: such a text is converted as a whole
    base = free << 7
    out = list(text)
    last = 0
    for start, end in sorted((n[0], n[1]) for ns in labelled.values() for n in ns) + [(len(text), len(text))]:
        for i in range(last, start):
            if out[i] in _SIGNS:
                out[i] = chr(base + ord(out[i]))
        last = max(last, end)
    return "".join(out), {base + ord(c): c for c in _SIGNS}


def clean(text: str, labelled: dict[str, list[tuple[int, int, str, float, str]]]) -> str:
    """Text without the labelled markup; signs outside the labelled spans stay as they are. What remains of the structure: headings as
    ``# ``, items as ``- ``, code between lines of three backticks, table rows as ``| a | b |`` and formulas between dollar signs."""
    out, back = hidden(text, labelled)
    if "latex" in labelled:
        out = re.sub(r"\\(?:sub)*section\*?\{([^{}]*)\}", r"\n# \1\n", out)
        out = re.sub(r"\\(?:textbf|textit|emph|underline|texttt|title)\{([^{}]*)\}", r"\1", out)
        out = re.sub(r"\s?\\footnote\{([^{}]*)\}", r" (\1)", out)
        out = re.sub(r"~?\\(?:cite|ref|label|eqref)\{[^{}]*\}", "", out)
        out = re.sub(r"\\begin\{(?:equation|align|displaymath)\*?\}\s*(.*?)\s*\\end\{(?:equation|align|displaymath)\*?\}", r"$\1$", out, flags=re.S)
        out = re.sub(r"\\\[\s*(.*?)\s*\\\]", r"$\1$", out, flags=re.S)
        out = re.sub(r"\\(?:begin|end)\{(?:verbatim|lstlisting)\}", "```", out)
        out = re.sub(r"^[ \t]*\\item\b[ \t]*", "- ", out, flags=re.M)
        out = re.sub(r"[ \t]*\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\[[^\]\n]*\])?\n?", "", out)
    if "wiki" in labelled:
        out = re.sub(r"\[\[(?:Category|File|Image|Kategorie|Datei|Fichier|Archivo|Plik|Fil|Ficheiro|Категория|Файл):[^\[\]]*\]\]\n?", "", out)
        out = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1", out)
        out = re.sub(r"\{\{(?:convert|cvt)\|([^{}|]*)\|([^{}|]*)[^{}]*\}\}", r"\1 \2", out)
        out = re.sub(r"\{\{Infobox[^{}]*\}\}", lambda m: "\n".join(_rows(x.replace("=", "|", 1)) for x in m[0].splitlines() if x.startswith("|")), out)
        out = re.sub(r"\{\{(?:[^{}|]*\|)?([^{}|]*)[^{}]*\}\}", r"\1", out)
        out = re.sub(r"'''(.+?)'''", r"\1", out, flags=re.S)
        out = re.sub(r"(?<![\w'])''(?=[^\s'])([^']+?)''(?![\w'])", r"\1", out)
        out = re.sub(r"^([*#:;]+) +", lambda m: "  " * (len(m[1]) - 1) + "- ", out, flags=re.M)
        out = re.sub(r"^(={2,6}) *([^=]+?) *\1[ \t]*$", lambda m: "#" * (len(m[1]) - 1) + " " + " ".join(m[2].split()), out, flags=re.M)
        out = re.sub(r"^(?:\{\|[^\n]*|\|-[^\n]*|\|\})[ \t]*\n?", "", out, flags=re.M)
        out = re.sub(r"^[|!](?![|}\-+])[^\n]*(?:\|\||!!)[^\n]*$", lambda m: _rows(m[0].replace("!!", "||").lstrip("!")), out, flags=re.M)
    if "markdown" in labelled:
        out = re.sub(r"!\[([^\]\[]*)\]\s?\(\s*[^()\s]+\s*\)", r"\1", out)
        out = re.sub(r"\[([^\]\[]+)\]\s?\(\s*[^()\s]+\s*\)", r"\1", out)
        out = re.sub(r"(?<!\*)\*\*(?=[^\s*])([^*]+?)\*\*(?!\*)", r"\1", out)
        out = re.sub(r"(?<![\w*])\*(?=[^\s*])([^*]+?)(?<=[^\s*])\*(?![\w*])", r"\1", out)
        out = re.sub(r"(?<![\w_])__(?=[^\s_])([^_]+?)__(?![\w_])", r"\1", out)
        out = re.sub(r"(?<![\w_])_(?=[^\s_])([^_\n]+?)_(?![\w_])", r"\1", out)
        out = re.sub(r"(?<!~)~~(?=[^\s~])([^~]+?)~~(?!~)", r"\1", out)
        out = re.sub(r"(?<!`)`(?=[^\s`])([^`]+?)`(?!`)", r"\1", out)
        out = re.sub(r"^([^\n#]\S[^\n]*)\n(?:={3,}|-{3,})[ \t]*$", r"# \1", out, flags=re.M)
        out = re.sub(r"^\|? ?:?-{3,}:? ?(?:\| ?:?-{2,}:? ?)+\|?[ \t]*\n?", "", out, flags=re.M)
        out = re.sub(r"^> ?", "", out, flags=re.M)
    if "html" in labelled:
        out = re.sub(r"<!--.*?-->|<(script|style|noscript)\b[^>]*>.*?</\1\s*>", "", out, flags=re.S | re.I)
        out = re.sub(r"<h([1-6])\b[^>]*>(.*?)</h\1\s*>", lambda m: "\n" + "#" * int(m[1]) + f" {m[2].strip()}\n", out, flags=re.S | re.I)
        out = re.sub(r"<li\b[^>]*>\s*", "\n- ", out, flags=re.I)
        out = re.sub(r"<pre\b[^>]*>\s*(?:<code\b[^>]*>)?(.*?)(?:</code\s*>)?\s*</pre\s*>", "\n```\n\\1\n```\n", out, flags=re.S | re.I)
        out = re.sub(r"<tr\b[^>]*>(.*?)</tr\s*>", lambda m: "\n| " + " | ".join(x.strip() for x in re.findall(r"<t[hd]\b[^>]*>(.*?)</t[hd]\s*>", m[1], flags=re.S | re.I)) + " |", out, flags=re.S | re.I)
        out = re.sub(r"<img\b[^>]*\balt=(['\"])(.*?)\1[^>]*>", r"\2", out, flags=re.S | re.I)
        out = re.sub(r"<(?:br|p|div|ul|ol|table|hr)\b[^>]*>|</(?:p|div|ul|ol|table)\s*>", "\n", out, flags=re.I)
        out = re.sub(r"</?([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?/?>", lambda m: "" if m[1].lower() in ELEMENTS else m[0], out)
        once = html.unescape(out)
        if once != out:  # escaped tags
            once = re.sub(r"</?([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?/?>", lambda m: "" if m[1].lower() in ELEMENTS else m[0], once)
        out = once.replace("\xa0", " ")
    return re.sub(r"\n{3,}", "\n\n", _SPACED.sub("", out)).strip().translate(back)


def residue(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """key columns, kind, n_cues, clean: one row per kind of markup left in the text of a row; clean is the text
    without any of its markup (the same for each kind of the row).

    Null, empty and blank texts, and texts without any cue, give no row; whole texts of any length are read. Repeated rows stay
    repeated. Signs alone (a price, an inch sign, arithmetic, a path, a placeholder in angle brackets) have negative
    weights or no cue, so they fall on the content side unless markup of their kind is next to them. An empty table gives
    no rows. Columns other than key and text are ignored.
    """
    schema = T.StructType(
        [*[rows.schema[k] for k in key], T.StructField("kind", T.StringType()), T.StructField("n_cues", T.IntegerType()), T.StructField("clean", T.StringType())]
    )
    names = [*key, "kind", "n_cues", "clean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        memo: dict[str, list[tuple[str, int, str]]] = {}
        for b in batches:
            take, kinds, counts, cleaned = [], [], [], []
            for i, s in enumerate(b.column(len(key)).to_pylist()):
                if (got := memo.get(s)) is None:
                    got = [(k, len(ns), c) for lab in [labeller.label(s)] if lab for c in [clean(s, lab)] for k, ns in lab.items()]
                    if len(s) < 200 and len(memo) < 200_000:  # memory only
                        memo[s] = got
                for k, n, c in got:
                    take.append(i)
                    kinds.append(k)
                    counts.append(n)
                    cleaned.append(c)
            ids = [b.column(j).take(pa.array(take, pa.int64())) for j in range(len(key))]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(kinds, pa.string()), pa.array(counts, pa.int32()), pa.array(cleaned, pa.string())], names=names)

    return rows.select(*key, F.col(text)).filter(F.col(text).rlike(GATE)).mapInArrow(run, schema)
