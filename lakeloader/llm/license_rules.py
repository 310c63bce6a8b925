"""The signatures of the license scan: one regular expression over words each.

A signature's words are lower-case and separated by one blank, as the scan makes
them (`GPL-3.0-or-later` reads `gpl 3 0 or later`). Its first word is plain: only
places with that word try it. A text is scanned at all if it has one of the
signature's gate words. Of overlapping detections the smaller priority is stronger.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

@dataclass(frozen=True)
class Signature:
    keyword: str
    gates: tuple[str, ...]
    regex: str
    label: str
    priority: int
    relevance: float


#: label | names, separated by `;` | versions. A version `3 0` also reads `3`.
FAMILIES = """
gpl | gnu general public licen[sc]e; gnu gpl; gpl; general public licen[sc]e | 1 0, 2 0, 3 0
lgpl | gnu lesser general public licen[sc]e; gnu library general public licen[sc]e; gnu lgpl; lgpl; lesser general public licen[sc]e | 2 0, 2 1, 3 0
agpl | gnu affero general public licen[sc]e; gnu agpl; agpl; affero general public licen[sc]e | 1 0, 3 0
gfdl | gnu free documentation licen[sc]e; gnu fdl; gfdl; free documentation licen[sc]e | 1 1, 1 2, 1 3
apache | apache software licen[sc]e; apache licen[sc]e; apache; asl | 1 0, 1 1, 2 0
mpl | mozilla public licen[sc]e; mpl | 1 0, 1 1, 2 0
epl | eclipse public licen[sc]e; epl | 1 0, 2 0
cpl | common public licen[sc]e; cpl | 1 0
cddl | common development and distribution licen[sc]e; cddl | 1 0, 1 1
eupl | european union public licen[sc]e; eupl | 1 0, 1 1, 1 2
afl | academic free licen[sc]e; afl | 1 2, 2 0, 2 1, 3 0
osl | open software licen[sc]e; osl | 1 0, 2 0, 2 1, 3 0
artistic | artistic licen[sc]e; artistic | 1 0, 2 0
bsl | boost software licen[sc]e; bsl | 1 0
zpl | zope public licen[sc]e; zpl | 1 1, 2 0, 2 1
lppl | latex project public licen[sc]e; lppl | 1 0, 1 2, 1 3
ofl | sil open font licen[sc]e; open font licen[sc]e; ofl | 1 0, 1 1
php | php licen[sc]e; php | 3 0, 3 01
python | python software foundation licen[sc]e; psf licen[sc]e; psf | 2 0
odbl | open database licen[sc]e; odbl | 1 0
odc-by | open data commons attribution licen[sc]e; odc by | 1 0
cecill | cecill free software licen[sc]e; cecill licen[sc]e; cecill | 1 0, 1 1, 2 0, 2 1
ms-pl | microsoft public licen[sc]e; ms pl |
ms-rl | microsoft reciprocal licen[sc]e; ms rl |
rpl | reciprocal public licen[sc]e; rpl | 1 1, 1 5
qpl | q public licen[sc]e; qpl | 1 0
sspl | server side public licen[sc]e; sspl | 1 0
busl | business source licen[sc]e; busl | 1 1
elastic | elastic licen[sc]e; elastic | 1 0, 2 0
blueoak | blue oak model licen[sc]e; blueoak | 1 0 0
upl | universal permissive licen[sc]e; upl | 1 0
ncsa | university of illinois ncsa open source licen[sc]e; ncsa open source licen[sc]e; ncsa licen[sc]e |
ecl | educational community licen[sc]e; ecl | 1 0, 2 0
watcom | sybase open watcom public licen[sc]e; open watcom public licen[sc]e | 1 0
apsl | apple public source licen[sc]e; apsl | 1 0, 1 1, 1 2, 2 0
ipl | ibm public licen[sc]e; ipl | 1 0
npl | netscape public licen[sc]e; npl | 1 0, 1 1
sleepycat | sleepycat licen[sc]e; sleepycat |
vim | vim licen[sc]e |
ruby | ruby licen[sc]e |
openssl | openssl licen[sc]e |
postgresql | postgresql licen[sc]e |
zlib | zlib libpng licen[sc]e; zlib licen[sc]e |
isc | isc licen[sc]e |
curl | curl licen[sc]e |
x11 | x11 licen[sc]e; mit x11 licen[sc]e |
mit-0 | mit no attribution licen[sc]e; mit no attribution; mit 0 |
mit | mit licen[sc]e; expat licen[sc]e; mit expat licen[sc]e |
0bsd | zero clause bsd licen[sc]e; zero clause bsd; 0bsd licen[sc]e; 0bsd |
bsd | bsd licen[sc]e; bsd style licen[sc]e |
unlicense | unlicense |
wtfpl | do what the f[a-z]* you want to public licen[sc]e; wtfpl | 1 0, 2 0
json | json licen[sc]e |
beerware | beer ware licen[sc]e; beerware licen[sc]e; beerware |
"""

#: label | priority | relevance | signature
SINGLE = """
bsd-2-clause | 2 | 0.9 | bsd (?:2|two) clause(?: simplified)?(?: licen[sc]e)?
bsd-2-clause | 2 | 0.9 | simplified bsd licen[sc]e
bsd-2-clause | 2 | 0.9 | 2 clause bsd(?: licen[sc]e)?
bsd-3-clause | 2 | 0.9 | bsd (?:3|three) clause(?: new| revised)?(?: licen[sc]e)?
bsd-3-clause | 2 | 0.9 | new bsd licen[sc]e
bsd-3-clause | 2 | 0.9 | modified bsd licen[sc]e
bsd-3-clause | 2 | 0.9 | 3 clause bsd(?: licen[sc]e)?
bsd-4-clause | 2 | 0.9 | bsd (?:4|four) clause(?: original| old)?(?: licen[sc]e)?
bsd-4-clause | 2 | 0.9 | original bsd licen[sc]e
cc0 | 2 | 0.9 | cc0(?: 1 0)?(?: universal)?
cc0 | 2 | 0.9 | creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?
cc-by | 4 | 0.6 | cc by
cc-by | 4 | 0.6 | creative commons attribution
unlicense | 3 | 0.8 | unlicense org
public-domain | 4 | 0.6 | public domain dedication
public-domain | 4 | 0.7 | dedicated to the public domain
public-domain | 4 | 0.7 | released into the public domain
proprietary | 5 | 0.5 | all rights reserved
gpl | 1 | 1.0 | licensed under (?:the )?(?:gnu )?gpl
gpl | 1 | 1.0 | redistribute it and or modify it under the terms of the gnu general
apache-2.0 | 1 | 1.0 | www apache org licenses license 2 0
gpl | 2 | 0.9 | www gnu org licenses gpl
lgpl | 2 | 0.9 | www gnu org licenses lgpl
agpl | 2 | 0.9 | www gnu org licenses agpl
mpl-2.0 | 1 | 1.0 | mozilla org mpl 2 0
mit | 1 | 1.0 | permission is hereby granted free of charge to any person obtaining a
isc | 1 | 1.0 | permission to use copy modify and or distribute this software for any
bsd | 1 | 1.0 | redistribution and use in source and binary forms with or without modification
zlib | 1 | 1.0 | software is provided as is without any express or implied warranty
bsl-1.0 | 1 | 1.0 | boost org license 1 0 txt
wtfpl | 1 | 1.0 | everyone is permitted to copy and distribute verbatim or modified copies
proprietary | 2 | 0.8 | proprietary and confidential
proprietary | 2 | 0.8 | unauthorized copying of this file
"""

#: Creative Commons: terms of the short and of the long name.
CC_TERMS = {
    "by": "attribution",
    "by nc": "attribution noncommercial",
    "by sa": "attribution sharealike",
    "by nd": "attribution noderivatives",
    "by nc sa": "attribution noncommercial sharealike",
    "by nc nd": "attribution noncommercial noderivatives",
}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
SPDX = "spdx"


def _rows(text: str) -> list[list[str]]:
    return [[cell.strip() for cell in line.split("|", 3)] for line in text.strip().splitlines()]


def _rule(regex: str, label: str, priority: int, relevance: float) -> Signature:
    keyword = re.match("[0-9a-z]+", regex)[0]
    always = regex
    while always != (always := re.sub(r"\(\?:[^()]*\)\??|[^ ()]\?", "", always)):
        pass
    plain = [word for word in always.split() if re.fullmatch("[0-9a-z]+", word)]
    gates = ("licence", "license") if "licen[sc]e" in always.split() else (max([*plain, ""], key=len) or keyword,)
    return Signature(keyword, gates, f"^(?:{regex}) ", label, priority, relevance)


def _family(label: str, names: list[str], versions: list[str]) -> list[Signature]:
    made = []
    for name in names:
        short = " " not in name
        for version in versions:
            # `2 0` reads `2`, `v2`, `version 2 0`; `2 1` keeps both its numbers.
            number = version.removesuffix(" 0") + (r"(?: 0)?" if version.endswith(" 0") else "")
            tail = r"(?: (?:only|or (?:any )?later(?: version)?))?"
            title = f"{label}-{version.replace(' ', '.')}"
            made.append(_rule(f"{name}(?: licen[sc]e)?(?: version| v)? v?{number}{tail}", title, 1, 0.8 if short else 1.0))
            if short:
                made.append(_rule(f"{name}v{version.split()[0]}{tail}", title, 1, 0.8))
        if not short or not versions:
            made.append(_rule(name, label, 3, 0.9))
        elif label not in ("apache", "php", "python", "artistic", "elastic"):
            made.append(_rule(name, label, 4, 0.5))
    return made


def signatures() -> list[Signature]:
    """All signatures, the stronger first."""
    made: list[Signature] = []
    for cells in _rows(FAMILIES):
        label, names, versions = cells[0], cells[1], cells[2] if len(cells) > 2 else ""
        made += _family(label, [x.strip() for x in names.split(";")], [x.strip() for x in versions.split(",") if x.strip()])
    for label, priority, relevance, regex in _rows(SINGLE):
        made.append(_rule(regex, label, int(priority), float(relevance)))
    for short, long in CC_TERMS.items():
        label = f"cc-{short.replace(' ', '-')}"
        long = long.replace("noncommercial", "non ?commercial").replace("sharealike", "share ?alike").replace("noderivatives", "no ?derivatives")
        for version in CC_VERSIONS:
            title = f"{label}-{version.replace(' ', '.')}"
            made.append(_rule(f"cc {short}(?: licen[sc]e)?(?: version)? v?{version}(?: international| unported)?", title, 1, 0.9))
            made.append(_rule(f"creative commons {long}(?: licen[sc]e)?(?: version)? v?{version}", title, 1, 1.0))
            made.append(_rule(f"creativecommons org licenses {short} {version}", title, 1, 1.0))
        made.append(_rule(f"cc {short}(?: licen[sc]e)?", label, 3, 0.7))
        made.append(_rule(f"creative commons {long}(?: licen[sc]e)?", label, 3, 0.8))
    identified = [
        _rule(f"spdx license identifier {rule.regex[4:-2]}", rule.label, 0, 1.0)
        for rule in made
        if rule.keyword in ("gpl", "lgpl", "agpl", "apache", "mpl", "epl", "cc") and rule.priority == 1
    ]
    identified += [_rule(f"spdx license identifier {name}", name, 0, 1.0) for name in ("mit", "isc", "zlib", "unlicense", "0bsd")]
    return sorted(dict.fromkeys([*identified, *made]), key=lambda rule: (rule.priority, rule.keyword, rule.regex))


def window(rules: list[Signature]) -> int:
    """Words that the longest signature can match: every word of its text, its optional ones included."""
    return max((rule.regex.count(" ") for rule in rules), default=1)
