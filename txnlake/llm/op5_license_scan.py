"""License scans: notice phrases and tagged license expressions.

One Aho-Corasick automaton over the words of a text finds notice phrases and the
identifier tag. Behind a tag, a shunting-yard parser reads the and / or / with
expression and evaluates it: `or` leaves the choice of the freer side, `and`
binds to the stricter one, `with` and a known exception lighten the license before
it. Names count as a whole: those of known licenses in all their versions, and
references to licenses of the text's own. Any other word has no label. An
expression of any length is read in linear time; it ends at the first token that
does not fit, or at a line end outside parentheses.

Defined results: a null text counts as empty and has no words, places or labels
and a score of 0. A tag without a readable expression gives no label. Very long
texts are read in linear time, each in a portion of its own. Repeated
rows each give a row. An empty table gives no rows. Columns other than id and
text are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from txnlake.llm.common import map_arrow, portions, texts

#: Fixed phrases and labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further notices, of this method.
NOTICES = {
    "all rights reserved": "all-rights-reserved",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"

#: Fixed identifiers: a pattern for the whole of one, its label, and how much it asks for (0: nothing, 3: most).
#: A version may be left out, and be written as in GPLv3.
IDENTIFIERS = [
    (r"agpl-?v?{1.0|3.0|1|3}{-only|-or-later}", "agpl", 3),
    (r"gpl-?v?{1.0|2.0|3.0|1|2|3}{-only|-or-later}", "gpl", 3),
    (r"gpl-[23].0-with-(?:autoconf|bison|classpath|font|gcc)-exception", "gpl", 2),
    (r"lgpl-?v?{2.0|2.1|3.0|2|3}{-only|-or-later}", "lgpl", 2),
    (r"gfdl{-1.1|-1.2|-1.3}{-invariants|-no-invariants}{-only|-or-later}", "gfdl", 3),
    (r"apache{-1.0|-1.1|-2.0}", "apache", 1),
    (r"0bsd", "0bsd", 0),
    (r"bsd{-1-clause|-2-clause|-3-clause|-4-clause}{-patent|-views|-attribution|-clear|-lbnl|-modification|-uc}", "bsd", 1),
    (r"mit", "mit", 1),
    (r"mit-0", "mit-0", 0),
    (r"mit-(?:advertising|cmu|feh|festival|modern-variant|open-group|wu)", "mit", 1),
    (r"isc", "isc", 1),
    (r"x11", "x11", 1),
    (r"zlib", "zlib", 1),
    (r"ncsa", "ncsa", 1),
    (r"bsl-1.0", "bsl", 1),
    (r"postgresql", "postgresql", 1),
    (r"(?:psf|python){-2.0|-2.0.1}", "python", 1),
    (r"unicode-(?:3.0|dfs-2015|dfs-2016|tou)", "unicode", 1),
    (r"upl-1.0", "upl", 1),
    (r"w3c", "w3c", 1),
    (r"wtfpl", "wtfpl", 0),
    (r"mpl{-1.0|-1.1|-2.0}{-no-copyleft-exception}", "mpl", 2),
    (r"epl{-1.0|-2.0}", "epl", 2),
    (r"cddl{-1.0|-1.1}", "cddl", 2),
    (r"artistic{-1.0|-2.0}{-perl|-cl8}", "artistic", 2),
    (r"ofl{-1.0|-1.1}{-rfn|-no-rfn}", "ofl", 2),
    (r"ms-(?:pl|rl)", "ms", 2),
    (r"eupl{-1.0|-1.1|-1.2}", "eupl", 3),
    (r"osl{-1.0|-1.1|-2.0|-2.1|-3.0}", "osl", 3),
    (r"busl-1.1", "busl", 3),
    (r"sspl-1.0", "sspl", 3),
    (r"odbl-1.0", "odbl", 2),
    (r"cc0{-1.0}", "public-domain", 0),
    (r"cc-pddc|pddl-1.0|unlicense", "public-domain", 0),
    (r"cc-by{VERSION}", "cc-by", 1),
    (r"cc-by-sa{VERSION}", "cc-by-sa", 2),
    (r"cc-by-nd{VERSION}", "cc-by-nd", 3),
    (r"cc-by-nc{VERSION}", "cc-by-nc", 3),
    (r"cc-by-nc-sa{VERSION}", "cc-by-nc-sa", 3),
    (r"cc-by-nc-nd{VERSION}", "cc-by-nc-nd", 3),
]
#: A version of a Creative Commons license, and the country that it was ported to.
_CC_VERSION = r"(?:-(?:1\.0|2\.0|2\.1|2\.5|3\.0|4\.0)(?:-[a-z][a-z][a-z]?)?)?"
#: Fixed names of exceptions, which free from one step of what a license asks for.
EXCEPTIONS = set(
    """autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0
    clisp-exception-2.0 ecos-exception-2.0 fltk-exception font-exception-2.0 freertos-exception-2.0 gcc-exception-2.0
    gcc-exception-3.1 gnu-javamail-exception gpl-3.0-linking-exception gpl-cc-1.0 i2p-gpl-java-exception
    lgpl-3.0-linking-exception libtool-exception linux-syscall-note llvm-exception mif-exception
    ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0 openvpn-openssl-exception qt-gpl-exception-1.0
    qt-lgpl-exception-1.1 qwt-exception-1.0 swift-exception u-boot-exception-2.0 universal-foss-exception-1.0
    wxwindows-exception-3.1""".split()
)
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
UNKNOWN = 3

#: Bytes that are no word characters become spaces; A-Z become lower case.
_NORMAL = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20) for b in range(256)
)
_NAME = r"([()]|(?:DocumentRef-[A-Za-z0-9.-]+:)?[A-Za-z0-9][A-Za-z0-9.+-]*)"
_TOKEN = re.compile(r"[ \t]*+" + _NAME)
#: Between parentheses an expression goes on over line ends.
_INNER_TOKEN = re.compile(r"[ \t\r\n]*+" + _NAME)
_REFERENCE = re.compile(r"(?:documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")
_TAG = re.compile(r"SPDX-License-Identifier:", re.IGNORECASE)


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def to_rpn(text: str, at: int = 0) -> list[str]:
    """The longest readable expression that starts at `at`, in reverse Polish order."""
    out: list[str] = []
    operators: list[str] = []
    wants_operand, depth = True, 0
    # How much of `out`, and which operators behind it, make the longest expression so far.
    done: tuple[int, list[str]] = (0, [])
    while match := (_INNER_TOKEN if depth else _TOKEN).match(text, at):
        token = match[1]
        word = token.lower()
        if token == "(" and wants_operand:
            operators.append(token)
            depth += 1
        elif token == ")" and not wants_operand and depth:
            while operators[-1] != "(":
                out.append(operators.pop())
            operators.pop()
            depth -= 1
        elif word in PRECEDENCE and not wants_operand:
            while operators and PRECEDENCE.get(operators[-1], 0) >= PRECEDENCE[word]:
                out.append(operators.pop())
            operators.append(word)
            wants_operand = True
        elif wants_operand and token not in "()" and word not in PRECEDENCE:
            out.append(token)
            wants_operand = False
        else:
            break
        at = match.end()
        if not wants_operand and not depth:
            # Outside parentheses there is at most one operator of each precedence.
            done = (len(out), operators[::-1])
    return out[: done[0]] + done[1]


def _pattern(written: str) -> str:
    """The regular expression of an identifier: parts in braces may be absent, dots are dots."""
    parts = re.sub(r"\{([^{}]*)\}", r"(?:\1)?", written.removesuffix("{VERSION}").replace(".", r"\."))
    return parts + _CC_VERSION if written.endswith("{VERSION}") else parts


_IDENTIFIERS = re.compile("|".join(f"({_pattern(written)})" for written, _, _ in IDENTIFIERS))


def judged(name: str) -> tuple[set[str], int]:
    """Label of a license's name, and how much it asks for. A name that is none has no label.

    A `+` behind an identifier allows later versions. A reference to a license of
    the text's own is its own label.
    """
    name = name.lower()
    if found := _IDENTIFIERS.fullmatch(name.removesuffix("+")):
        _, label, asks = IDENTIFIERS[found.lastindex - 1]
        return {label}, asks
    return ({name} if _REFERENCE.fullmatch(name) else set()), UNKNOWN


def evaluate(rpn: list[str]) -> tuple[set[str], int]:
    """Labels named in an expression, and how much it asks for; no labels if it is empty."""
    stack: list[tuple[set[str], int]] = []
    names: list[str] = []
    for token in rpn:
        if token not in PRECEDENCE:
            stack.append(judged(token))
            names.append(token)
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            # The exception is no license; its name is the one read last.
            known = names[-1].lower() in EXCEPTIONS
            stack.append((left[0], max(0, left[1] - 1) if known else left[1]))
        else:
            choose = min if token == "or" else max
            few, many = sorted((left[0], right[0]), key=len)
            many |= few
            stack.append((many, choose(left[1], right[1])))
    return stack[0] if stack else (set(), 0)


def scan(text: str) -> tuple[int, list[int], str, list[str], float, int | None]:
    """Words, starts of the base phrases, base labels, all labels, score, and what the tags ask for."""
    words = text.encode().translate(_NORMAL).split()
    joined = b" ".join([b"", *words, b""]).decode()
    starts, base, labels, tagged = [], set(), set(), False
    spaces = upto = 0
    for end, phrase in _automaton().iter(joined):
        spaces += joined.count(" ", upto, end + 1)
        upto = end + 1
        if phrase == TAG:
            tagged = True
        elif phrase in BASE:
            # A phrase of n words ends with the space behind its last one.
            starts.append(spaces - phrase.count(" ") - 2)
            base.add(BASE[phrase])
        else:
            labels.add(NOTICES[phrase])
    asks = None
    if tagged:
        for match in _TAG.finditer(text):
            found, much = evaluate(to_rpn(text, match.end()))
            if found:
                labels |= found
                asks = max(much, asks or 0)
    # Each place halves the doubt; a readable tag or another notice counts as one place.
    score = 1 - 0.5 ** min(len(starts) + len(labels - base), 50)
    return len(words), starts, ",".join(sorted(base)), sorted(base | labels), score, asks


SCHEMA = """doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,
base_labels string, labels string, score double, asks int"""


def license_scan(docs: DataFrame) -> DataFrame:
    """A row per document with the places and labels found: SCHEMA."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int32()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "asks"]
        for batch in portions(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                n, starts, base, labels, score, asks = scan(text or "")
                ends = (min(starts), max(starts)) if starts else (None, None)
                rows.append((n, len(starts), *ends, base, ",".join(labels), score, asks))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return map_arrow(texts(docs), scanned, SCHEMA)
