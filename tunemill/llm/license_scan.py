"""Licence mentions by ordered signature rules.

A text is lower-cased (A-Z) and cut into words (letters, digits, everything beyond ASCII). Each rule is a
pattern over these words, with a label, a priority and a keyword. Only rules whose keyword is
among a text's words are tried. Where detections overlap, one that lies inside another of higher
priority, or inside an equal one that is longer or comes earlier in the list, is dropped. The base phrases
are rules of the highest priority and are always kept.

A null text is empty. A text without words or without detections has no labels, null places and the
score 0. Null ids, ties and repeated rows are scanned row by row. Other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tunemill.llm.common import alnum_words, encoded, per_row

# Phrases that are counted, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label; name in words; identifier in words; keyword that every mention of it holds.
LICENCES = """
mit; mit license; mit; mit
mit-0; mit no attribution; mit 0; mit
apache-1; apache license version 1 1; apache 1 1; apache
apache-2; apache license version 2 0; apache 2 0; apache
bsd-1-clause; bsd 1 clause license; bsd 1 clause; bsd
bsd-2-clause; bsd 2 clause simplified license; bsd 2 clause; bsd
bsd-3-clause; bsd 3 clause new or revised license; bsd 3 clause; bsd
bsd-4-clause; bsd 4 clause original license; bsd 4 clause; bsd
0bsd; bsd zero clause license; 0bsd; *
isc; isc license; isc; isc
zlib; zlib license; zlib; zlib
gpl-1; gnu general public license version 1; gpl 1 0; *
gpl-2; gnu general public license version 2; gpl 2 0; *
gpl-3; gnu general public license version 3; gpl 3 0; *
lgpl-2; gnu lesser general public license version 2; lgpl 2 0; *
lgpl-2.1; gnu lesser general public license version 2 1; lgpl 2 1; *
lgpl-3; gnu lesser general public license version 3; lgpl 3 0; *
agpl-3; gnu affero general public license version 3; agpl 3 0; *
gfdl-1.2; gnu free documentation license version 1 2; gfdl 1 2; *
gfdl-1.3; gnu free documentation license version 1 3; gfdl 1 3; *
mpl-1; mozilla public license version 1 0; mpl 1 0; *
mpl-1.1; mozilla public license version 1 1; mpl 1 1; *
mpl-2; mozilla public license version 2 0; mpl 2 0; *
epl-1; eclipse public license version 1 0; epl 1 0; *
epl-2; eclipse public license version 2 0; epl 2 0; *
cddl-1; common development and distribution license version 1 0; cddl 1 0; *
cddl-1.1; common development and distribution license version 1 1; cddl 1 1; *
cpl-1; common public license version 1 0; cpl 1 0; *
eupl-1.1; european union public licence version 1 1; eupl 1 1; *
eupl-1.2; european union public licence version 1 2; eupl 1 2; *
artistic-1; artistic license version 1 0; artistic 1 0; artistic
artistic-2; artistic license version 2 0; artistic 2 0; artistic
boost-1; boost software license version 1 0; bsl 1 0; *
python-2; python software foundation license version 2; psf 2 0; *
ofl-1.1; sil open font license version 1 1; ofl 1 1; *
unlicense; the unlicense; unlicense; unlicense
wtfpl; do what the fuck you want to public license; wtfpl; *
cc0; creative commons zero; cc0 1 0; *
cc-by-3; creative commons attribution 3 0; cc by 3 0; *
cc-by-4; creative commons attribution 4 0; cc by 4 0; *
cc-by-sa-3; creative commons attribution sharealike 3 0; cc by sa 3 0; *
cc-by-sa-4; creative commons attribution sharealike 4 0; cc by sa 4 0; *
cc-by-nd-4; creative commons attribution noderivatives 4 0; cc by nd 4 0; *
cc-by-nc-3; creative commons attribution noncommercial 3 0; cc by nc 3 0; *
cc-by-nc-4; creative commons attribution noncommercial 4 0; cc by nc 4 0; *
cc-by-nc-sa-4; creative commons attribution noncommercial sharealike 4 0; cc by nc sa 4 0; *
cc-by-nc-nd-4; creative commons attribution noncommercial noderivatives 4 0; cc by nc nd 4 0; *
odbl-1; open database license version 1 0; odbl 1 0; *
odc-by-1; open data commons attribution license version 1 0; odc by 1 0; *
pddl-1; public domain dedication and license version 1 0; pddl 1 0; *
ms-pl; microsoft public license; ms pl; *
ms-rl; microsoft reciprocal license; ms rl; *
openssl; openssl license; openssl; openssl
php-3; php license version 3 0; php 3 0; php
ruby; ruby license; ruby; ruby
vim; vim license; vim; vim
w3c; w3c software notice and license; w3c; w3c
x11; x11 license; x11; x11
ncsa; university of illinois ncsa open source license; ncsa; ncsa
postgresql; postgresql license; postgresql; postgresql
bsl-1.1; business source license version 1 1; busl 1 1; *
sspl-1; server side public license version 1; sspl 1 0; *
elastic-2; elastic license version 2; elastic 2 0; elastic
commons-clause; commons clause license condition; commons clause; clause
openrail; open responsible ai license; openrail; *
"""

#: How a mention reads, its priority, and whether it needs the identifier or the name.
FORMS = (
    ("spdx license identifier {}", 90, "identifier"),
    ("(?:licensed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?{}", 80, "name"),
    ("(?:licensed|released|distributed|available) under (?:the )?{}", 75, "identifier"),
    ("under (?:the )?(?:terms of (?:the )?)?{}", 70, "name"),
    ("{} licen[sc]ed?", 60, "identifier"),
    ("{}", 50, "name"),
    ("licen[sc]e {}", 40, "identifier"),
)

# Mentions without a licence's name.
GENERAL = (
    ("proprietary", "all rights reserved", 30, b"reserved"),
    ("proprietary", "proprietary and confidential", 35, b"proprietary"),
    ("public-domain", "(?:released into|dedicated to|in) the public domain", 35, b"domain"),
    ("permissive", "permission is hereby granted free of charge", 45, b"hereby"),
    ("permissive", "redistribution and use in source and binary forms", 45, b"redistribution"),
    ("copyright", "copyright(?: c)? (?:19|20)[0-9]{2}", 20, b"copyright"),
)

#: Priority of the base phrases; no other rule reaches it.
CERTAIN = 100


class Rule(NamedTuple):
    label: str
    pattern: re.Pattern
    priority: int
    order: int
    keywords: frozenset


def _number(words: str) -> str:
    """A name with its version marker and last zero left open."""
    words = re.sub(r" version ", r" (?:version |v)?", words)
    return re.sub(r" 0$", r"(?: 0)?", words)


def _rule(label: str, pattern: str, priority: int, order: int, keywords: set[bytes]) -> Rule:
    return Rule(label, re.compile(b"(?<= )" + pattern.encode() + b"(?= )"), priority, order, frozenset(keywords))


def build_rules() -> list[Rule]:
    made = [(label, phrase, CERTAIN, {phrase.split()[-2].encode()}) for phrase, label in BASE.items()]
    for line in LICENCES.strip().splitlines():
        label, name, identifier, keyword = (part.strip() for part in line.split(";"))
        for form, priority, of in FORMS:
            words = name if of == "name" else identifier
            key = keyword if keyword != "*" else max(words.split(), key=len)
            made.append((label, form.format(_number(words)), priority, {key.encode()}))
    made += [(label, pattern, priority, {keyword}) for label, pattern, priority, keyword in GENERAL]
    return [_rule(*rule[:3], order, rule[3]) for order, rule in enumerate(made)]


RULES = build_rules()
KEYWORDS = frozenset(keyword for rule in RULES for keyword in rule.keywords)


class Detection(NamedTuple):
    label: str
    start: int
    end: int
    priority: int
    order: int


def kept(found: list[Detection]) -> list[Detection]:
    """Those that no stronger detection contains, in order of place.

    `reach` is a Fenwick tree over the starts: the furthest end of what stays and starts no later. So the work
    is n log n, however many mentions a text has.
    """
    stays: list[Detection] = []
    rank = {start: place for place, start in enumerate(sorted({one.start for one in found}), 1)}
    reach = [-1] * (len(rank) + 1)
    for one in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.order, d.start)):
        place, furthest = rank[one.start], -1
        while place:
            furthest = max(furthest, reach[place])
            place &= place - 1
        if one.priority != CERTAIN and furthest >= one.end:
            continue
        stays.append(one)
        place = rank[one.start]
        while place < len(reach):
            reach[place] = max(reach[place], one.end)
            place += place & -place
    return sorted(stays, key=lambda d: (d.start, d.end, d.order))


def detect(words: list[bytes]) -> list[Detection]:
    """All kept detections; places count words from 0, the end is not included."""
    present = KEYWORDS.intersection(words)
    if not present:
        return []
    text = b" " + b" ".join(words) + b" "
    starts = (np.cumsum([1] + [len(word) + 1 for word in words])[:-1]).tolist()
    found = []
    for rule in RULES:
        if rule.keywords & present:
            for match in rule.pattern.finditer(text):
                start, end = bisect_right(starts, match.start()) - 1, bisect_right(starts, match.end() - 1)
                found.append(Detection(rule.label, start, end, rule.priority, rule.order))
    return kept(found)


def license_scan(docs: DataFrame) -> DataFrame:
    """A row per row of `docs`: doc_id, n_words, what the base phrases give, labels, score, detections.

    score: priority of the strongest detection in hundredths. detections: label, start and end in words, priority.
    """

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch["text"].to_pylist():
            words = alnum_words(encoded(text))
            found = detect(words)
            base = [one for one in found if one.priority == CERTAIN]
            places = [one.start for one in base]
            out.append(
                (
                    len(words),
                    len(base),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted({one.label for one in base})),
                    ",".join(sorted({one.label for one in found})),
                    max((one.priority for one in found), default=0) / CERTAIN,
                    [{"label": d.label, "start": d.start, "end": d.end, "priority": d.priority} for d in found],
                )
            )
        spans = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())]))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.float64(), spans]
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        return pa.record_batch([batch["doc_id"], *columns], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, detections array<struct<label: string, start: long, end: long, priority: int>>"
    )
    return per_row(docs.select("doc_id", "text"), schema, rows)
