"""Secret scans that link the parts of a credential.

Strong spans are told by their own form. Weak ones - named identifiers, e-mail addresses, short or oddly named secrets, bare random strings,
endpoints - are told only where their complements stand nearby: a scope is the candidate's block of lines without a blank one,
cut to ``reach`` code points on either side, and scopes are joined with the sorted intervals of each role. The join counts
by binary search, so no pair is listed, and stays inside a row, so nothing is shuffled.

Defined cases: a null or empty text has no spans; spans of one kind never overlap; a weak span that overlaps a strong one
gives way to it; rows are looked at one by one, so repeated ids and rows keep their own spans; input columns named like a
result give way to it.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomerge.llm.common import map_texts, numbered, renamed

# The three kinds that are reported wherever they stand.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]+")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Between a name and its value.
TIES = r"""["']?\x20{0,8}[:=]\x20{0,8}["']?"""
NAMED_ID = re.compile(rf"""\b(?:access_?key(?:_?id)?|client_?id|user(?:_?name|_?id)?|login|account(?:_?id)?){TIES}([^\s"',;]{{3,128}})""", re.IGNORECASE | re.ASCII)
NAMED_SECRET = re.compile(rf"""\b(?:pass(?:phrase|code|wd|word)?|pwd|secret(?:_?access)?(?:_?key)?|client_?secret|private_?key|auth(?:_?token|_?key)?|credentials?){TIES}([^\s"',;]{{3,256}})""", re.IGNORECASE | re.ASCII)
SECRET_WORDS = ("pass", "pwd", "secret", "private", "auth", "credential")
BARE = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_-]{20,128}={0,2}(?![A-Za-z0-9+/_=-])")
URL = re.compile(r"""\b[a-z][a-z0-9+.-]{1,15}://(?:([^\s:/@"'<>]{1,128}):([^\s/@"'<>]{1,128})@)?([^\s/@"'<>]{3,255})""", re.IGNORECASE | re.ASCII)
HOST = re.compile(rf"""\b(?:host(?:_?name)?|server|endpoint|url|database|bucket|region){TIES}([^\s"',;]{{3,255}})""", re.IGNORECASE | re.ASCII)
ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b", re.ASCII)
BLANK = re.compile(r"\n[\x20\t\r]*\n")
#: All kinds, in the order that spans with one start are told in.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")


def strong_spans(text: str) -> list[tuple[int, int, str]]:
    """The leftmost matches of each kind that do not overlap, less those that are too short."""
    low, out = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= LEAST_HEX]


def looks_random(word: str) -> bool:
    """A digit, and capitals and small letters, neither of them rare."""
    return any(c.isdigit() for c in word) and min(sum(c.isupper() for c in word), sum(c.islower() for c in word)) >= 3


class Intervals:
    """Sorted starts and ends, to count the intervals that meet others."""

    def __init__(self, spans: list[tuple[int, int]]):
        import numpy as np

        self.starts, self.ends = np.sort([s for s, _ in spans]), np.sort([e for _, e in spans])

    def meet(self, low, high):
        """How many intervals meet each [low, high): all that begin before its end, but for those that end before it begins."""
        return self.starts.searchsorted(high, "left") - self.ends.searchsorted(low, "right")


def weak_spans(text: str, strong: list[tuple[int, int, str]], reach: int) -> list[tuple[int, int, str]]:
    """Candidates whose complements stand in their scope: a secret needs an identifier or an endpoint, an identifier a secret,
    an endpoint both."""
    import numpy as np

    low = text.lower()
    found: dict[str, list[tuple[int, int]]] = {"identifier": [], "secret": [], "endpoint": []}
    if any(w in low for w in SECRET_WORDS):
        found["secret"] += [m.span(1) for m in NAMED_SECRET.finditer(text)]
    found["secret"] += [m.span() for m in BARE.finditer(text) if looks_random(m[0])]
    for m in URL.finditer(text) if "://" in text else ():
        found["endpoint"].append(m.span(3))
        if m[1]:
            found["identifier"].append(m.span(1))
            found["secret"].append(m.span(2))
    held = {"identifier": [s[:2] for s in strong if s[2] == "access"], "secret": [s[:2] for s in strong if s[2] != "access"], "endpoint": []}
    if not found["secret"] and not held["secret"]:
        return []  # neither an identifier nor an endpoint is told without one
    found["identifier"] += [m.span(1) for m in NAMED_ID.finditer(text)]
    if "@" in text:  # what stands in a URL is told by its own parts
        inside = Intervals(found["secret"] + found["endpoint"])
        found["identifier"] += [m.span() for m in ADDRESS.finditer(text) if not inside.meet(*m.span())]
    found["endpoint"] += [m.span(1) for m in HOST.finditer(text)]
    known = Intervals([s[:2] for s in strong])
    for role, spans in found.items():
        if spans:
            own = np.array(sorted(set(spans)))
            own = own[known.meet(own[:, 0], own[:, 1]) == 0] if strong else own
            # of overlapping ones the first, and the longest of those with one start
            last, kept = -1, []
            for start, end in sorted(own.tolist(), key=lambda s: (s[0], -s[1])):
                if start >= last:
                    kept.append((start, end))
                    last = end
            found[role] = kept
    parts = {role: Intervals(found[role] + held[role]) for role in found}
    edges = np.array([0] + [m.end() for m in BLANK.finditer(text)] + [len(text)])
    out = []
    for role, spans in found.items():
        if not spans:
            continue
        own = np.array(spans)
        block = edges.searchsorted(own[:, 0], "right") - 1
        begin = np.maximum(edges[block], own[:, 0] - reach)
        end = np.maximum(np.minimum(edges[np.minimum(block + 1, len(edges) - 1)], own[:, 1] + reach), own[:, 1])
        near = {other: parts[other].meet(begin, end) > 0 for other in parts if other != role}
        told = near["identifier"] | near["endpoint"] if role == "secret" else near["secret"] if role == "identifier" else near["identifier"] & near["secret"]
        out += [(int(s), int(e), role) for (s, e), yes in zip(spans, told) if yes]
    return out


def scan(docs: DataFrame, text_col: str = "text", reach: int = 300, keep_text: bool = False) -> DataFrame:
    """Adds ``sec_spans``, an array of (kind, start, end) by start and kind, in code points, ``end`` exclusive."""
    rows, text = numbered(docs.withColumn(text_col, docs[text_col].cast("string")), text_col)

    def spans(t: str) -> list[dict]:
        strong = strong_spans(t)
        found = sorted((s, KINDS.index(k), e) for s, e, k in strong + weak_spans(t, strong, reach))
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]

    def make():
        return lambda texts: {"sec_spans": [spans(t) if t else [] for t in texts]}

    return renamed(map_texts(rows, text, make, "sec_spans array<struct<kind:string,start:long,end:long>>", keep_text), docs.columns, "sec_spans")


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the strong kinds, the hash of their spans, and all spans as text."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    strong = F.filter("sec_spans", lambda s: s["kind"].isin(*KINDS[:3]))
    counts = [F.size(F.array_remove(F.transform("sec_spans", lambda s: s["kind"] != k), True)).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select(id_col, *counts, F.sha2(shown(strong).cast("binary"), 256).alias("base_sha256"), shown(F.col("sec_spans")).alias("spans"))
