"""Licence evidence in whole texts.

An Aho-Corasick automaton over the words of a text finds notice phrases and identifier tags in
one pass. What follows a tag on its line is parsed as a licence expression by the shunting-yard algorithm and evaluated. An
operand is a known identifier (``FAMILIES``, ``SINGLE`` or the caller's) or a reference to a licence text of its own
(``LicenseRef-``, ``DocumentRef-``); after ``with`` stands a known exception. From the tightest to the loosest operator:
``with`` adds an exception to the identifier on its left, ``/`` and ``or`` need one side permitted, ``and`` and ``,`` both
(``/`` binds tighter than ``and``, ``or`` looser, a comma loosest of all).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.shingles import binary_values, folded_words, slices

# Phrases (words in a row) and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
MORE_PHRASES = {
    "gnu general public license version 2": "gpl-2", "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "european union public licence": "eupl", "common development and distribution license": "cddl", "server side public license": "sspl",
    "business source license": "busl", "elastic license 2 0": "elastic", "open software license": "osl", "academic free license": "afl",
    "artistic license": "artistic", "boost software license": "bsl", "isc license": "isc", "zlib license": "zlib",
    "python software foundation license": "psf", "postgresql license": "postgresql", "universal permissive license": "upl",
    "microsoft public license": "ms-pl", "microsoft reciprocal license": "ms-rl", "sil open font license": "ofl",
    "bsd 2 clause": "bsd-2", "bsd 3 clause": "bsd-3", "bsd 4 clause": "bsd-4",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "free and unencumbered software released into the public domain": "unlicense", "dedicated to the public domain": "public-domain",
    "cc by 4 0": "cc-by", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc0 1 0": "cc0", "creative commons zero": "cc0",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution 4 0": "cc-by",
    "open data commons attribution license": "odc-by", "open database license": "odbl", "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
# Identifier families with their versions; an identifier is the family, a hyphen and a version. Its label is the family,
# with the major version in the families of MAJOR. Those of GNU may end in -only or -or-later.
FAMILIES = {
    "afl": "1.1 1.2 2.0 2.1 3.0", "agpl": "1.0 3.0", "apache": "1.0 1.1 2.0", "apsl": "1.0 1.1 1.2 2.0", "artistic": "1.0 2.0",
    "blueoak": "1.0.0", "bsl": "1.0", "busl": "1.1", "cc-by": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nc-nd": "1.0 2.0 2.5 3.0 4.0", "cc-by-nc-sa": "1.0 2.0 2.5 3.0 4.0", "cc-by-nd": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-sa": "1.0 2.0 2.5 3.0 4.0", "cc0": "1.0", "cddl": "1.0 1.1", "cdla-permissive": "1.0 2.0", "cdla-sharing": "1.0",
    "cecill": "1.0 1.1 2.0 2.1", "cpal": "1.0", "cpl": "1.0", "ecl": "1.0 2.0", "efl": "1.0 2.0", "elastic": "2.0", "epl": "1.0 2.0",
    "eupl": "1.0 1.1 1.2", "gfdl": "1.1 1.2 1.3", "gpl": "1.0 2.0 3.0", "ipl": "1.0", "lgpl": "2.0 2.1 3.0", "libpng": "2.0",
    "lppl": "1.0 1.1 1.2 1.3a 1.3c", "lpl": "1.0 1.02", "mpl": "1.0 1.1 2.0", "mulanpsl": "1.0 2.0", "nasa": "1.3", "nposl": "3.0",
    "odbl": "1.0", "odc-by": "1.0", "ofl": "1.0 1.1", "ogl-uk": "1.0 2.0 3.0", "oldap": "2.0 2.4 2.7 2.8", "osl": "1.0 1.1 2.0 2.1 3.0",
    "pddl": "1.0", "php": "3.0 3.01", "polyform-noncommercial": "1.0.0", "polyform-small-business": "1.0.0", "psf": "2.0", "python": "2.0",
    "qpl": "1.0", "rpl": "1.1 1.5", "sgi-b": "1.0 1.1 2.0", "simpl": "2.0", "sissl": "1.0 1.2", "sspl": "1.0", "unicode": "3.0",
    "upl": "1.0", "watcom": "1.0", "xfree86": "1.1", "zend": "2.0", "zimbra": "1.3 1.4", "zpl": "1.1 2.0 2.1",
}
GNU, MAJOR = ("agpl", "gfdl", "gpl", "lgpl"), ("apache", "gpl")
# Identifiers without a version; they are their own labels.
SINGLE = ("0bsd aal beerware bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause cecill-b cecill-c"
          " curl fsfap ftl hpnd icu ijg intel isc json libpng mit mit-0 mit-cmu ms-pl ms-rl ncsa netcdf ngpl nokia openssl postgresql"
          " ruby sleepycat ssh-openssh tcl unicode-dfs-2015 unicode-dfs-2016 unicode-tou unlicense vim w3c wtfpl x11 xnet zlib").split()
SHORT = {"bsd-1-clause": "bsd-1", "bsd-2-clause": "bsd-2", "bsd-3-clause": "bsd-3", "bsd-4-clause": "bsd-4"}
# Exceptions that may follow ``with``.
EXCEPTIONS = frozenset(
    "389-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0"
    " clisp-exception-2.0 ecos-exception-2.0 fltk-exception font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1"
    " gpl-3.0-linking-exception libtool-exception linux-syscall-note llvm-exception lzma-exception mif-exception"
    " ocaml-lgpl-linking-exception openjdk-assembly-exception-1.0 openvpn-openssl-exception ps-or-pdf-font-exception-20170817"
    " qt-gpl-exception-1.0 qt-lgpl-exception-1.1 qwt-exception-1.0 swift-exception u-boot-exception-2.0 universal-foss-exception-1.0"
    " wxwindows-exception-3.1".split())
PERMITTED = frozenset("0bsd apache-2 bsd-1 bsd-2 bsd-3 bsl cc-by cc0 curl isc libpng mit mit-0 mit-cmu ncsa odc-by pddl php postgresql psf"
                      " public-domain python unlicense upl wtfpl x11 zlib zpl".split())

_TAGGED = re.compile(rb"spdx[-\s]license[-\s]identifier\s*:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"[(),/]|[A-Za-z0-9.+:-]+|[^\s\w(),/]+|\w+")
_RANK = {",": 1, "or": 2, "and": 3, "/": 4, "with": 5}
_LIST = (",", "/")
_OWN = re.compile(r"(documentref-[a-z0-9.-]+:)?licenseref-[a-z0-9.-]+")


@lru_cache(maxsize=1)
def known_identifiers() -> dict[str, str]:
    """Identifier -> label, in lower case, from the families and their versions."""
    out = {name: SHORT.get(name, name) for name in SINGLE}
    for family, versions in FAMILIES.items():
        for version in versions.split():
            label = f"{family}-{version.split('.')[0]}" if family in MAJOR else family
            for ending in ("", "-only", "-or-later") if family in GNU else ("",):
                out[f"{family}-{version}{ending}"] = label
    return out


def label_of(token: str, more: frozenset[str] = frozenset()) -> str | None:
    """The label of an identifier (``+`` for later versions may follow a version) or of a reference; None for any other word."""
    token = token.lower()
    bare = token.removesuffix("+") if token[-2:-1].isdigit() else token
    return known_identifiers().get(bare) or (token if token in more or _OWN.fullmatch(token) else None)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", BASE_PHRASES), ("more", MORE_PHRASES), ("tag", {TAG: ""})):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    found.make_automaton()
    return found


def to_postfix(text: str, more: frozenset[str] = frozenset()) -> list[str] | None:
    """Shunting-yard: the longest well-formed expression that ``text`` starts with, in postfix order; None without one.

    A word that cannot follow (two licences in a row, ``with`` after a parenthesis, prose after the expression) ends it, and so
    does a comma or slash that no operand follows. An open parenthesis that is never closed, and a word operator without an
    operand or with an unknown one, make it malformed. A full stop or colon after an operand is punctuation.
    """
    out, held, operand_next, named, before_list = [], [], True, False, None
    for token in _TOKEN.findall(text):
        op = token.lower()
        word = op.rstrip(".:")
        if operand_next and op == "(" and (not held or held[-1] != "with"):
            held.append("(")
        elif operand_next and op not in _RANK and (word in EXCEPTIONS or word.startswith("additionref-") if held and held[-1] == "with"
                                                   else label_of(word or ".", more)):
            out.append(word)
            named, operand_next, before_list = not (held and held[-1] == "with"), False, None
        elif not operand_next and op in _RANK and (named or op != "with"):
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[op]:
                out.append(held.pop())
            if op in _LIST and "(" not in held:
                before_list = out + held[::-1]
            held.append(op)
            operand_next = True
        elif not operand_next and op == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            named = False
        else:
            break
    if operand_next or "(" in held:
        return before_list
    return out + held[::-1]


def evaluate(postfix: list[str], more: frozenset[str] = frozenset()) -> tuple[bool, set[str]]:
    """Whether the expression can be met with permitted licences, and the labels it names, exceptions included."""
    stack: list[tuple[bool, set[str]]] = []
    for token in postfix:
        if token in _RANK:
            (right, names_r), (left, names_l) = stack.pop(), stack.pop()
            if token == "with":  # an exception loosens the licence, but does not make it a permitted one
                may = left
            else:
                may = left and right if token in ("and", ",") else left or right
            stack.append((may, names_l | names_r))
        else:
            label = label_of(token, more) or token
            stack.append((label in PERMITTED, {label}))
    return stack.pop()


def scan(text: bytes | None, more: frozenset[str] = frozenset()) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, permitted) of one text."""
    words = folded_words(text)
    joined = " " + b" ".join(words).decode("latin-1") + " "
    base, labels, starts, tagged, noticed = set(), set(), [], False, []
    place = at = 0
    for end, (kind, label, size) in _automaton().iter(joined):
        start = end - size + 1
        if kind == "tag":
            tagged = True
            continue
        labels.add(label)
        noticed.append(label in PERMITTED)
        if kind == "base":
            base.add(label)
            # Places come in order of their ends and phrases differ in length, so the count may step back.
            place += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
            at = start
            starts.append(place)
    score = 0.9 if base else 0.6 if labels else 0.0
    if tagged:
        for found in _TAGGED.findall(text):
            postfix = to_postfix(found.decode("utf-8", "replace"), more)
            if postfix is None:
                score = max(score, 0.3)
                continue
            may, names = evaluate(postfix, more)
            labels |= names
            noticed.append(may)
            score = 1.0
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score, all(noticed) if noticed else None)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more_identifiers: Iterable[str] = ()) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score, permitted.

    ``score`` is the strength of the evidence: 1 for a tag with an expression that parses, 0.9 for a base
    phrase, 0.6 for another phrase, 0.3 for a tag without a known licence, 0 for nothing. ``permitted`` tells whether all
    statements can be met with permitted licences (null without any). ``more_identifiers`` are accepted after a tag besides the
    known ones and are their own labels. Null and empty texts have no words and nothing found; texts of any length are scanned
    whole; repeated rows give equal rows, ids may be null; extra columns are ignored, whatever their names; an empty table gives
    an empty result. No shuffle.
    """
    more = frozenset(i.lower() for i in more_identifiers)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permitted")

    def run(batches):
        for batch in slices(batches, 1):
            rows = list(zip(*(scan(t, more) for t in binary_values(batch.column(1))))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds))], names=["id", *names])

    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = docs.mapInArrow(run, "id long, n_words long, n_base long, first_word long, last_word long,"
                                 " base_labels string, labels string, score double, permitted boolean")
    return found.select(F.col("id").alias(id_col), *names)
