"""License scans (1): ordered signature rules with keyword prefilter and containment suppression.

``RULES`` are regular expressions over the lower-cased text (A-Z only): for each licence its SPDX
tag, the notices that grant or release it, its declaration and its bare title: five forms of each
title, some 480 in all. A rule runs only where all its keywords stand in the text. Detections are
taken in order of priority, then length, then place; one that lies within a detection taken before
is suppressed: in "GNU Lesser General Public License" the title of the GPL is no detection of its
own. The time is about linear in a text's length and detections: white space is matched without
backtracking, and suppression looks up one maximum. Text is worked on per document in the tasks;
nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _rolling as R
from ._common import batch_of, keyed, slices, table
from .minhash_dedup import LOWER

IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Base phrases, as words that stand consecutively, and their labels.
BASE = {("under", "the", "mit", "license"): "mit", ("apache", "license", "version", "2"): "apache-2", ("cc", "by", "nc"): "cc-by-nc"}

_V = r"(?:,?\s*(?:version|ver\.?|v)?\s*)"
_L = r"\s+licen[cs]e"
# label, SPDX identifiers, title, keywords that every match of the title holds
_LICENSES = [
    ("mit", r"mit", r"mit(?:\s+x11)?" + _L, ("mit", "licen")),
    ("mit-0", r"mit-0", r"mit\s+no\s+attribution(?:" + _L + ")?", ("mit", "no", "attribution")),
    ("x11", r"x11", r"x11" + _L, ("x11", "licen")),
    ("isc", r"isc", r"isc" + _L, ("isc", "licen")),
    ("apache-1", r"apache-1\.[01]", r"apache(?:\s+software)?" + _L + _V + r"1\.[01]", ("apache", "licen")),
    ("apache-2", r"apache-2\.0", r"apache(?:\s+software)?(?:" + _L + r")?" + _V + r"2(?:\.0)?\b", ("apache",)),
    ("bsd-2-clause", r"bsd-2-clause(?:-\w+)?", r"(?:simplified|freebsd|(?:2|two)[- ]clause)\s+bsd" + _L + r"|bsd\s+(?:2|two)[- ]clause", ("bsd",)),
    ("bsd-3-clause", r"bsd-3-clause(?:-\w+)?", r"(?:new|modified|revised|(?:3|three)[- ]clause)\s+bsd" + _L + r"|bsd\s+(?:3|three)[- ]clause", ("bsd",)),
    ("bsd-4-clause", r"bsd-4-clause(?:-\w+)?", r"(?:original|old|(?:4|four)[- ]clause)\s+bsd" + _L + r"|bsd\s+(?:4|four)[- ]clause", ("bsd",)),
    ("0bsd", r"0bsd", r"(?:zero|0)[- ]clause\s+bsd|bsd\s+zero\s+clause", ("bsd",)),
    ("bsd", r"bsd", r"bsd" + _L, ("bsd", "licen")),
    ("gpl-1", r"gpl-1\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?general\s+public" + _L + _V + r"1\b", ("general", "public")),
    ("gpl-2", r"gpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:general\s+public" + _L + r"|gpl)" + _V + r"2(?:\.0)?\b", ("gpl|general", "2")),
    ("gpl-3", r"gpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:general\s+public" + _L + r"|gpl)" + _V + r"3(?:\.0)?\b", ("gpl|general", "3")),
    ("gpl", r"gpl", r"(?:gnu\s+)?general\s+public" + _L + r"|gnu\s+gpl", ("gpl|general",)),
    ("lgpl-2", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:library|lesser)\s+general\s+public" + _L + _V + r"2(?:\.0)?\b(?!\.1)", ("general", "public")),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:lesser\s+general\s+public" + _L + r"|lgpl)" + _V + r"2\.1\b", ("lgpl|lesser", "2.1")),
    ("lgpl-3", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:lesser\s+general\s+public" + _L + r"|lgpl)" + _V + r"3(?:\.0)?\b", ("lgpl|lesser", "3")),
    ("lgpl", r"lgpl", r"(?:gnu\s+)?(?:library|lesser)\s+general\s+public" + _L + r"|gnu\s+lgpl", ("gnu|lesser|library",)),
    ("agpl-3", r"agpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu\s+)?(?:affero\s+general\s+public" + _L + r"|agpl)" + _V + r"3(?:\.0)?\b", ("affero|agpl",)),
    ("agpl", r"agpl", r"(?:gnu\s+)?affero\s+general\s+public" + _L, ("affero",)),
    ("gfdl", r"gfdl-1\.[123](?:-\w+)*", r"gnu\s+free\s+documentation" + _L, ("free", "documentation")),
    ("mpl-1.1", r"mpl-1\.1", r"mozilla\s+public" + _L + _V + r"1\.1", ("mozilla",)),
    ("mpl-2", r"mpl-2\.0(?:-\w+)*", r"mozilla\s+public" + _L + _V + r"2(?:\.0)?\b", ("mozilla",)),
    ("mpl", r"mpl", r"mozilla\s+public" + _L, ("mozilla",)),
    ("epl-1", r"epl-1\.0", r"eclipse\s+public" + _L + _V + r"1(?:\.0)?\b", ("eclipse",)),
    ("epl-2", r"epl-2\.0", r"eclipse\s+public" + _L + _V + r"2(?:\.0)?\b", ("eclipse",)),
    ("edl-1", r"bsd-3-clause", r"eclipse\s+distribution" + _L, ("eclipse", "distribution")),
    ("cddl-1", r"cddl-1\.[01]", r"common\s+development\s+and\s+distribution" + _L, ("common", "distribution")),
    ("cpl-1", r"cpl-1\.0", r"common\s+public" + _L, ("common", "public")),
    ("cpal-1", r"cpal-1\.0", r"common\s+public\s+attribution" + _L, ("public", "attribution")),
    ("artistic-1", r"artistic-1\.0(?:-\w+)*", r"artistic" + _L + _V + r"1(?:\.0)?\b", ("artistic",)),
    ("artistic-2", r"artistic-2\.0", r"artistic" + _L + _V + r"2(?:\.0)?\b", ("artistic",)),
    ("artistic", r"artistic", r"artistic" + _L, ("artistic",)),
    ("bsl-1", r"bsl-1\.0", r"boost\s+software" + _L, ("boost",)),
    ("busl-1.1", r"busl-1\.1", r"business\s+source" + _L, ("business", "source")),
    ("sspl-1", r"sspl-1\.0", r"server\s+side\s+public" + _L, ("server", "side")),
    ("elastic-2", r"elastic-2\.0", r"elastic" + _L, ("elastic",)),
    ("zlib", r"zlib", r"zlib" + _L, ("zlib",)),
    ("libpng", r"libpng(?:-2\.0)?", r"(?:lib)?png\s+reference\s+library" + _L + r"|libpng" + _L, ("png",)),
    ("openssl", r"openssl", r"openssl" + _L, ("openssl",)),
    ("curl", r"curl", r"curl" + _L, ("curl",)),
    ("unlicense", r"unlicense", r"\bunlicense\b", ("unlicense",)),
    ("wtfpl", r"wtfpl", r"\bwtfpl\b|do\s+what\s+the\s+f\S+\s+you\s+want\s+to\s+public" + _L, ("wtfpl|what",)),
    ("public-domain", r"public-domain", r"(?:in|into|to)\s+the\s+public\s+domain", ("domain",)),
    ("psf-2", r"psf-2\.0|python-2\.0(?:\.1)?", r"python(?:\s+software\s+foundation)?" + _L, ("python",)),
    ("php-3", r"php-3\.0[01]?", r"php" + _L, ("php",)),
    ("ruby", r"ruby", r"ruby" + _L, ("ruby",)),
    ("postgresql", r"postgresql", r"postgresql" + _L, ("postgresql",)),
    ("ncsa", r"ncsa", r"(?:university\s+of\s+illinois/)?ncsa(?:\s+open\s+source)?" + _L, ("ncsa",)),
    ("ofl-1.1", r"ofl-1\.[01](?:-\w+)*", r"(?:sil\s+)?open\s+font" + _L, ("open", "font")),
    ("afl-3", r"afl-3\.0", r"academic\s+free" + _L, ("academic",)),
    ("osl-3", r"osl-3\.0", r"open\s+software" + _L, ("open", "software")),
    ("ms-pl", r"ms-pl", r"microsoft\s+public" + _L, ("microsoft",)),
    ("ms-rl", r"ms-rl", r"microsoft\s+reciprocal" + _L, ("microsoft",)),
    ("eupl-1.2", r"eupl-1\.[12]", r"european\s+union\s+public" + _L, ("european",)),
    ("cecill-2.1", r"cecill-(?:b|c|[12]\.[01])", r"cecill(?:-[bc])?(?:" + _L + ")?", ("cecill",)),
    ("odbl-1", r"odbl-1\.0", r"open\s+database" + _L, ("open", "database")),
    ("odc-by", r"odc-by-1\.0", r"open\s+data\s+commons\s+attribution" + _L, ("open", "commons", "attribution")),
    ("pddl-1", r"pddl-1\.0", r"public\s+domain\s+dedication\s+and" + _L, ("dedication",)),
    ("lppl-1.3", r"lppl-1\.3[ac]?", r"latex\s+project\s+public" + _L, ("latex",)),
    ("ipl-1", r"ipl-1\.0", r"ibm\s+public" + _L, ("ibm",)),
    ("apsl-2", r"apsl-2\.0", r"apple\s+public\s+source" + _L, ("apple",)),
    ("hpnd", r"hpnd", r"historical\s+permission\s+notice", ("historical",)),
    ("upl-1", r"upl-1\.0", r"universal\s+permissive" + _L, ("universal",)),
    ("vim", r"vim", r"vim" + _L, ("vim",)),
    ("w3c", r"w3c(?:-\d+)?", r"w3c(?:\s+software(?:\s+and\s+document)?)?(?:\s+notice\s+and)?" + _L, ("w3c",)),
    ("qpl-1", r"qpl-1\.0", r"q\s+public" + _L, ("q", "public")),
    ("sleepycat", r"sleepycat", r"sleepycat" + _L, ("sleepycat",)),
    ("openrail", r"openrail(?:-\+\+|-m)?", r"(?:open\s*rail(?:-m)?|responsible\s+ai)" + _L, ("rail|responsible",)),
    ("cc0", r"cc0-1\.0", r"\bcc0\b(?:\s*1\.0)?|creative\s+commons\s+zero", ("cc0|zero",)),
    ("proprietary", r"licenseref-proprietary", r"all\s+rights\s+reserved", ("all", "reserved")),
]
_CC = [("by", r"attribution"), ("by-sa", r"attribution[- ]share[- ]?alike"), ("by-nc", r"attribution[- ]non[- ]?commercial"), ("by-nd", r"attribution[- ]no[- ]?deriv\w*"),
       ("by-nc-sa", r"attribution[- ]non[- ]?commercial[- ]share[- ]?alike"), ("by-nc-nd", r"attribution[- ]non[- ]?commercial[- ]no[- ]?deriv\w*")]
#: name, pattern around a title or an identifier, priority, keywords of its own
_FORMS = [("spdx", r"spdx-license-identifier:\s*(?:{id})(?![\w.+-])", 100, ("spdx",)),
          ("grant", r"(?:re)?licen[cs]ed\s+(?:to\s+you\s+)?under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{title})", 80, ("under",)),
          ("release", r"(?:released|distributed|published|available|provided|covered|offered)\s+(?:under|by)\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?(?:{title})", 80, ()),
          ("declared", r"\blicen[cs]e\s*[:=]\s*[\"']?(?:{id}|{title})(?![\w-])", 70, ("licen",)),
          ("title", r"(?<![\w-])(?:{title})", 40, ())]


@dataclass(frozen=True)
class Rule:
    label: str
    form: str
    priority: int
    keywords: tuple[str, ...]  # all must stand in the text; a|b: one of them
    pattern: str


def _rules() -> list[Rule]:
    licenses = list(_LICENSES)
    for name, words in _CC:
        for version in (r"4\.0", r"3\.0", r"2\.[05]", ""):
            label = f"cc-{name}" + (f"-{version[0]}" if version else "")
            tail = r"(?:\s+|-)" + version if version else r"(?![\w-])"
            title = rf"(?:cc[\s-]{name.replace('-', '[ -]')}|creative\s+commons\s+{words}(?:\s+licen[cs]e)?(?:\s+international)?){tail}"
            licenses.append((label, rf"cc-{name}-{version}" if version else rf"cc-{name}", title, ("cc|creative",)))
    out = []
    for label, ids, title, keys in licenses:
        for form, pattern, priority, own in _FORMS:
            by_id = form in ("spdx", "declared")
            out.append(Rule(label, form, priority + bool(re.search(r"\d", label)), own if by_id else own + keys, pattern.replace("{id}", ids).replace("{title}", title)))
    return out


RULES = _rules()


def compiled() -> list[tuple[Rule, list[tuple[bytes, ...]], re.Pattern]]:
    """Rules with their keywords and patterns, whose white space is possessive: what follows it in a rule
    never begins with it, so none need be given back."""
    return [(r, [tuple(k.encode() for k in key.split("|")) for key in r.keywords],
             re.compile(r.pattern.replace(r"\s+", r"\s++").replace(r"\s*", r"\s*+").encode())) for r in RULES]


def detections(text: bytes, rules) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of a lower-cased text that are not suppressed, in order of acceptance."""
    there: dict[bytes, bool] = {}

    def stands(k: bytes) -> bool:
        if k not in there:
            there[k] = k in text
        return there[k]

    found = [(m.start(), m.end(), rule) for rule, keys, pattern in rules
             if all(any(stands(k) for k in alike) for alike in keys) for m in pattern.finditer(text)]
    found.sort(key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label))
    place = {s: i + 1 for i, s in enumerate(sorted({s for s, _, _ in found}))}
    furthest = [0] * (len(place) + 1)  # Fenwick tree: the largest end among those taken that start no later
    kept: list[tuple[int, int, Rule]] = []
    for s, e, rule in found:
        i, end = place[s], 0
        while i:
            end = max(end, furthest[i])
            i &= i - 1
        if end < e:
            kept.append((s, e, rule))
            i = place[s]
            while i < len(furthest):
                furthest[i] = max(furthest[i], e)
                i += i & -i
    return kept


_TOKEN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_places(text: bytes) -> list[tuple[int, str]]:
    """(word number, label) of each place where a base phrase's words stand consecutively."""
    phrases = [(tuple(w.encode() for w in p), label) for p, label in BASE.items()]
    phrases = [(p, label) for p, label in phrases if all(w in text for w in p)]
    if not phrases:
        return []
    words = _TOKEN.findall(text)
    return sorted((i, label) for p, label in phrases for i, w in enumerate(words) if w == p[0] and tuple(words[i:i + len(p)]) == p)


_OUT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<s:int,e:int,label:string,form:string>>"


def _scan(batches):
    span = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("label", pa.string()), ("form", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])
    rules = compiled()
    for batch in batches:
        out = {f.name: [] for f in schema if f.name != "doc_id"}
        for _, _, data, at in slices(batch.column("text")):
            low = LOWER[data]
            out["n_words"].extend(np.diff(R.words(low, at, IS_WORD)[2]).tolist())
            for s, e in zip(at[:-1], at[1:], strict=True):
                text = low[s:e].tobytes()
                base, found = base_places(text), detections(text, rules)
                labels = {label for _, label in base}
                out["n_base"].append(len(base))
                out["first_word"].append(base[0][0] if base else None)
                out["last_word"].append(base[-1][0] if base else None)
                out["base_labels"].append(",".join(sorted(labels)))
                out["labels"].append(",".join(sorted(labels | {r.label for _, _, r in found})))
                out["score"].append(max([0.9 if base else 0.0, *(min(r.priority, 100) / 100 for _, _, r in found)]))
                out["spans"].append([{"s": a, "e": b, "label": r.label, "form": r.form} for a, b, r in sorted(found, key=lambda x: x[:2])])
        yield batch_of(schema, doc_id=batch.column("doc_id"), **out)


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words; n_base, first_word, last_word, base_labels of the base
    phrases; labels (those and the rules'); score: the strongest evidence, 0 to 1 (SPDX tag 1,
    base phrase 0.9, grant 0.8, declaration 0.7, bare title 0.4); spans: accepted detections as
    byte ranges of the UTF-8 text.

    NULL and empty texts have no words, labels "" and score 0. Every input row gives a row,
    repeated ones too; a NULL id stays NULL. Other columns are left out.
    """
    return keyed(docs, id_col, text_col).select("doc_id", "text").mapInArrow(_scan, _OUT)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")
