"""Operator 8, license scans: ordered signature rules.

A text is reduced to lower-case words.  One Aho-Corasick pass finds which
gate keywords stand in it; only the rules behind those keywords run, so most
texts run none.  A rule is a regular expression over the words with a label,
a priority and a weight.  Detections are taken by falling priority (then the
longer, then the earlier); one that lies inside a taken detection is
suppressed, so "GNU General Public License, version 3" does not also report
an unversioned GPL.  A general rule ("licensed under") also yields to any
detection that it overlaps.  A short name with a version ("PHP 3.0") is a
detection only beside a word that makes it a license.

The rules are written by hand, one line each, with their keyword.  Texts of
any length are judged whole; suppression takes a binary search a detection.

Cases: null and empty texts have no words, no labels and score 0; equal
detections of two rules: the earlier rule wins; repeated rows get equal
results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The contract's phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_BLANK = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


@dataclass(frozen=True)
class Rule:
    label: str
    gate: str          # the rule runs only on texts that hold this string
    pattern: re.Pattern
    priority: int
    weight: float


# Ways to say that a license applies; OF: "version 2 0" and the like before a name.
SHORTHANDS = {
    "UNDER": r"(?:(?:licensed|released|distributed|available|published|provided|covered) under (?:the |an |a )?(?:terms (?:and conditions )?of (?:the )?)?)",
    "LATER": r"(?: or (?:\(?at your option )?(?:any )?(?:later|newer)(?: version)?| only)?",
    "V": r"(?:version |v |ver |v)?",
    "YEAR": r"(?:19|20)[0-9]{2}",
}
WEIGHTS = {100: 1.0, 90: 1.0, 80: 1.0, 70: 0.9, 60: 0.8, 50: 0.8, 40: 0.6, 10: 0.3}

# The signature rules, by hand: label | priority | keyword that gates it | pattern over blank-joined words.
# 100 identifiers, 90 decisive words of a text, 80 named with a version, 70 named as applying, 60 short forms beside
# a word that makes them a license, 50 names, 40 families, 10 general words, which yield to any overlapping detection.
SIGNATURES = """
apache-2.0 | 100 | spdx | spdx license identifier apache 2 0
mit | 100 | spdx | spdx license identifier mit
bsd-2-clause | 100 | spdx | spdx license identifier bsd 2 clause
bsd-3-clause | 100 | spdx | spdx license identifier bsd 3 clause
isc | 100 | spdx | spdx license identifier isc
mpl-2.0 | 100 | spdx | spdx license identifier mpl 2 0
epl-2.0 | 100 | spdx | spdx license identifier epl 2 0
unlicense | 100 | spdx | spdx license identifier unlicense
cc0-1.0 | 100 | spdx | spdx license identifier cc0 1 0
0bsd | 100 | spdx | spdx license identifier 0bsd
zlib | 100 | spdx | spdx license identifier zlib
bsl-1.0 | 100 | spdx | spdx license identifier bsl 1 0
gpl-2.0 | 100 | spdx | spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 | 100 | spdx | spdx license identifier gpl 3 0(?: only| or later)?
lgpl-2.1 | 100 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | 100 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | 100 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
cc-by-4.0 | 100 | spdx | spdx license identifier cc by 4 0
cc-by-sa-4.0 | 100 | spdx | spdx license identifier cc by sa 4 0
mit | 90 | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | 90 | above copyright notice and this permission | the above copyright notice and this permission notice shall be included in all copies
bsd | 90 | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 90 | endorse or promote products | may be used to endorse or promote products derived from this software without specific prior written permission
bsd | 90 | redistributions of source code | redistributions of source code must retain the above copyright notice
isc | 90 | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee
zlib | 90 | altered source versions | altered source versions must be plainly marked as such
zlib | 90 | without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors
unlicense | 90 | free and unencumbered | this is free and unencumbered software released into the public domain
wtfpl | 90 | do what the fuck | do what the fuck you want to
apache-2.0 | 90 | you may not use this file except | you may not use this file except in compliance with the license
gpl | 90 | this program is free software | this program is free software you can redistribute it and or modify it
lgpl | 90 | this library is free software | this library is free software you can redistribute it and or modify it
gpl | 90 | distributed in the hope | distributed in the hope that it will be useful but without any warranty
mpl-2.0 | 90 | this source code form is subject | this source code form is subject to the terms of the mozilla public license V2 0
epl | 90 | accompanying materials are made available | this program and the accompanying materials are made available under the terms of the eclipse public license
gfdl | 90 | permission is granted to copy | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
bsl-1.0 | 90 | boost software license | distributed under the boost software license V1 0
public-domain | 90 | public domain | (?:released into|dedicated to|placed in|in) the public domain
public-domain | 90 | no known copyright | no known copyright restrictions
cc0-1.0 | 90 | cc0 1 0 | cc0 1 0(?: universal)?
cc0 | 90 | cc0 | cc0(?: license| licence| waiver| dedication)?
cc0 | 90 | creative commons zero | creative commons zero
cc0 | 90 | waived all copyright | waived all copyright and related or neighboring rights
reserved | 90 | all rights reserved | all rights reserved
reserved | 90 | some rights reserved | some rights reserved
reserved | 90 | no part of this | no part of this (?:publication|book|work|document|site|website) may be (?:reproduced|copied|used)
proprietary | 90 | proprietary and confidential | proprietary and confidential
proprietary | 90 | confidential and proprietary | confidential and proprietary
proprietary | 90 | unauthorized copying | unauthorized copying of this (?:file|document|work)
proprietary | 90 | trade secret | trade secrets? (?:of|and is the property of)
permission | 90 | used by permission | used by permission
permission | 90 | used with permission | used with permission
permission | 90 | reproduced with permission | reproduced with permission
permission | 90 | prior written permission | without (?:the )?prior written permission
permission | 90 | may not be copied | may not be copied
permission | 90 | may not be reproduced | may not be reproduced
permission | 90 | for personal use only | for personal use only
permission | 90 | non commercial use only | for non commercial use only
copyright | 90 | copyright | copyright (?:c )?YEAR
copyright | 90 | copyright | copyright (?:by|of)(?= [a-z])
copyright | 90 | c 2 | c 2[0-9]{3} by
apache-1.0 | 80 | apache | UNDER?apache (?:software )?license V1 0
apache-1.1 | 80 | apache | UNDER?apache (?:software )?license V1 1
apache-2.0 | 80 | apache | UNDER?apache (?:software )?license V2(?: 0)?
apache-2.0 | 80 | apache | version 2 0 of the apache (?:software )?license
mpl-1.0 | 80 | mozilla | UNDER?mozilla public license V1 0
mpl-1.1 | 80 | mozilla | UNDER?mozilla public license V1 1
mpl-2.0 | 80 | mozilla | UNDER?mozilla public license V2(?: 0)?
epl-1.0 | 80 | eclipse | UNDER?eclipse public license V1(?: 0)?
epl-2.0 | 80 | eclipse | UNDER?eclipse public license V2(?: 0)?
gpl-1 | 80 | general public license | UNDER?(?:gnu )?general public license V1(?: 0)?LATER
gpl-2 | 80 | general public license | UNDER?(?:gnu )?general public license V2(?: 0)?LATER
gpl-3 | 80 | general public license | UNDER?(?:gnu )?general public license V3(?: 0)?LATER
gpl-2 | 80 | general public license | version 2 of the (?:gnu )?general public license
gpl-3 | 80 | general public license | version 3 of the (?:gnu )?general public license
gpl-2 | 80 | general public license | general public license as published by the free software foundation either version 2LATER
gpl-3 | 80 | general public license | general public license as published by the free software foundation either version 3LATER
lgpl-2 | 80 | library general public license | UNDER?(?:gnu )?library general public license V2(?: 0)?LATER
lgpl-2.1 | 80 | lesser general public license | UNDER?(?:gnu )?lesser general public license V2 1LATER
lgpl-3 | 80 | lesser general public license | UNDER?(?:gnu )?lesser general public license V3(?: 0)?LATER
agpl-1 | 80 | affero general public license | UNDER?(?:gnu )?affero general public license V1(?: 0)?LATER
agpl-3 | 80 | affero general public license | UNDER?(?:gnu )?affero general public license V3(?: 0)?LATER
eupl-1.1 | 80 | european union public | UNDER?european union public licen[cs]e V1 1
eupl-1.2 | 80 | european union public | UNDER?european union public licen[cs]e V1 2
afl-2.1 | 80 | academic free license | UNDER?academic free license V2 1
afl-3.0 | 80 | academic free license | UNDER?academic free license V3(?: 0)?
osl-2.1 | 80 | open software license | UNDER?open software license V2 1
osl-3.0 | 80 | open software license | UNDER?open software license V3(?: 0)?
cddl-1.0 | 80 | common development and distribution | UNDER?common development and distribution license V1 0
cddl-1.1 | 80 | common development and distribution | UNDER?common development and distribution license V1 1
cpl-1.0 | 80 | common public license | UNDER?common public license V1 0
artistic-1.0 | 80 | artistic license | UNDER?artistic license V1(?: 0)?
artistic-2.0 | 80 | artistic license | UNDER?artistic license V2(?: 0)?
gfdl-1.1 | 80 | free documentation license | UNDER?(?:gnu )?free documentation license V1 1LATER
gfdl-1.2 | 80 | free documentation license | UNDER?(?:gnu )?free documentation license V1 2LATER
gfdl-1.3 | 80 | free documentation license | UNDER?(?:gnu )?free documentation license V1 3LATER
ofl-1.0 | 80 | open font license | UNDER?(?:sil )?open font license V1 0
ofl-1.1 | 80 | open font license | UNDER?(?:sil )?open font license V1 1
bsl-1.0 | 80 | boost software license | UNDER?boost software license V1 0
php-3.0 | 80 | php license | UNDER?php license V3 0
php-3.01 | 80 | php license | UNDER?php license V3 01
lppl-1.2 | 80 | latex project public license | UNDER?latex project public license V1 2LATER
lppl-1.3 | 80 | latex project public license | UNDER?latex project public license V1 3[abc]?LATER
busl-1.1 | 80 | business source license | UNDER?business source license V1 1
elastic-1.0 | 80 | elastic license | UNDER?elastic license V1(?: 0)?
elastic-2.0 | 80 | elastic license | UNDER?elastic license V2(?: 0)?
sspl-1.0 | 80 | server side public license | UNDER?server side public license V1(?: 0)?
odbl-1.0 | 80 | open database license | UNDER?open database license V1(?: 0)?
odc-by-1.0 | 80 | open data commons attribution | UNDER?open data commons attribution license V1(?: 0)?
upl-1.0 | 80 | universal permissive license | UNDER?universal permissive license V1(?: 0)?
blueoak-1.0 | 80 | blue oak model license | UNDER?blue oak model license V1 0 0
cecill-2.1 | 80 | cecill | UNDER?cecill(?: free software)?(?: license)? V2 1
ogl-3.0 | 80 | open government licence | UNDER?open government licence V3(?: 0)?
bsd-2-clause | 80 | bsd | UNDER?(?:the )?(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: license| licence)
bsd-3-clause | 80 | bsd | UNDER?(?:the )?(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: license| licence)
bsd-4-clause | 80 | bsd | UNDER?(?:the )?(?:bsd 4 clause|4 clause bsd|original bsd)(?: license| licence)
cc-by-1.0 | 80 | cc by | UNDER?cc by 1 0
cc-by-2.0 | 80 | cc by | UNDER?cc by 2 0
cc-by-2.5 | 80 | cc by | UNDER?cc by 2 5
cc-by-3.0 | 80 | cc by | UNDER?cc by 3 0
cc-by-4.0 | 80 | cc by | UNDER?cc by 4 0
cc-by-sa-2.0 | 80 | cc by | UNDER?cc by sa 2 0
cc-by-sa-2.5 | 80 | cc by | UNDER?cc by sa 2 5
cc-by-sa-3.0 | 80 | cc by | UNDER?cc by sa 3 0
cc-by-sa-4.0 | 80 | cc by | UNDER?cc by sa 4 0
cc-by-nc-2.0 | 80 | cc by | UNDER?cc by nc 2 0
cc-by-nc-2.5 | 80 | cc by | UNDER?cc by nc 2 5
cc-by-nc-3.0 | 80 | cc by | UNDER?cc by nc 3 0
cc-by-nc-4.0 | 80 | cc by | UNDER?cc by nc 4 0
cc-by-nd-2.0 | 80 | cc by | UNDER?cc by nd 2 0
cc-by-nd-3.0 | 80 | cc by | UNDER?cc by nd 3 0
cc-by-nd-4.0 | 80 | cc by | UNDER?cc by nd 4 0
cc-by-nc-sa-2.0 | 80 | cc by | UNDER?cc by nc sa 2 0
cc-by-nc-sa-2.5 | 80 | cc by | UNDER?cc by nc sa 2 5
cc-by-nc-sa-3.0 | 80 | cc by | UNDER?cc by nc sa 3 0
cc-by-nc-sa-4.0 | 80 | cc by | UNDER?cc by nc sa 4 0
cc-by-nc-nd-2.0 | 80 | cc by | UNDER?cc by nc nd 2 0
cc-by-nc-nd-3.0 | 80 | cc by | UNDER?cc by nc nd 3 0
cc-by-nc-nd-4.0 | 80 | cc by | UNDER?cc by nc nd 4 0
cc-by-2.0 | 80 | creative commons | UNDER?creative commons attribution (?:license )?2 0(?: generic)?
cc-by-3.0 | 80 | creative commons | UNDER?creative commons attribution (?:license )?3 0(?: unported)?
cc-by-4.0 | 80 | creative commons | UNDER?creative commons attribution (?:license )?4 0(?: international)?
cc-by-sa-2.5 | 80 | creative commons | UNDER?creative commons attribution share ?alike (?:license )?2 5(?: generic)?
cc-by-sa-3.0 | 80 | creative commons | UNDER?creative commons attribution share ?alike (?:license )?3 0(?: unported)?
cc-by-sa-4.0 | 80 | creative commons | UNDER?creative commons attribution share ?alike (?:license )?4 0(?: international)?
cc-by-nc-3.0 | 80 | creative commons | UNDER?creative commons attribution non ?commercial (?:license )?3 0(?: unported)?
cc-by-nc-4.0 | 80 | creative commons | UNDER?creative commons attribution non ?commercial (?:license )?4 0(?: international)?
cc-by-nd-3.0 | 80 | creative commons | UNDER?creative commons attribution no ?deriv(?:ative)?s?(?: works)? (?:license )?3 0(?: unported)?
cc-by-nd-4.0 | 80 | creative commons | UNDER?creative commons attribution no ?deriv(?:ative)?s?(?: works)? (?:license )?4 0(?: international)?
cc-by-nc-sa-3.0 | 80 | creative commons | UNDER?creative commons attribution non ?commercial share ?alike (?:license )?3 0(?: unported)?
cc-by-nc-sa-4.0 | 80 | creative commons | UNDER?creative commons attribution non ?commercial share ?alike (?:license )?4 0(?: international)?
cc-by-nc-nd-3.0 | 80 | creative commons | UNDER?creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? (?:license )?3 0(?: unported)?
cc-by-nc-nd-4.0 | 80 | creative commons | UNDER?creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? (?:license )?4 0(?: international)?
apache | 70 | apache | UNDERapache(?: software)? licen[cs]e
mit | 70 | mit | UNDER(?:mit|expat|x11) licen[cs]e
bsd | 70 | bsd | UNDERbsd(?: style)? licen[cs]e
isc | 70 | isc | UNDERisc licen[cs]e
gpl | 70 | gpl | UNDER(?:gnu )?gpl(?: licen[cs]e)?
gpl | 70 | general public license | UNDER(?:gnu )?general public license
lgpl | 70 | lgpl | UNDER(?:gnu )?lgpl(?: licen[cs]e)?
agpl | 70 | agpl | UNDER(?:gnu )?agpl(?: licen[cs]e)?
mpl | 70 | mozilla | UNDERmozilla public license
epl | 70 | eclipse | UNDEReclipse public license
cc | 70 | creative commons | UNDERcreative commons(?: licen[cs]e)?
unlicense | 70 | unlicense | UNDERunlicense
mit | 70 | mit | UNDERmit
bsd | 70 | bsd | UNDERbsd
apache-2.0 | 60 | apache | UNDERapache V2(?: 0)?
apache-2.0 | 60 | apache | apache V2(?: 0)? licen[cs]ed?
gpl-2 | 60 | gpl | UNDER?(?:gnu )?gpl (?:v ?|version )2(?: 0)?LATER
gpl-3 | 60 | gpl | UNDER?(?:gnu )?gpl (?:v ?|version )3(?: 0)?LATER
gpl-2 | 60 | gplv2 | UNDER?(?:gnu )?gplv2(?: 0)?LATER
gpl-3 | 60 | gplv3 | UNDER?(?:gnu )?gplv3(?: 0)?LATER
gpl-2 | 60 | gpl | UNDER(?:gnu )?gpl 2(?: 0)?LATER
gpl-3 | 60 | gpl | UNDER(?:gnu )?gpl 3(?: 0)?LATER
lgpl-2.1 | 60 | lgpl | UNDER?(?:gnu )?lgpl ?(?:v ?|version )2 1LATER
lgpl-3 | 60 | lgpl | UNDER?(?:gnu )?lgpl ?(?:v ?|version )3(?: 0)?LATER
agpl-3 | 60 | agpl | UNDER?(?:gnu )?agpl ?(?:v ?|version )3(?: 0)?LATER
mpl-1.1 | 60 | mpl | UNDERmpl V1 1
mpl-2.0 | 60 | mpl | UNDERmpl V2(?: 0)?
epl-1.0 | 60 | epl | UNDERepl V1(?: 0)?
epl-2.0 | 60 | epl | UNDERepl V2(?: 0)?
ofl-1.1 | 60 | ofl | UNDER?sil ofl V1 1
apache | 50 | apache | apache (?:software )?licen[cs]e
mit | 50 | mit licen | mit licen[cs]e
mit | 50 | expat licen | expat licen[cs]e
mit | 50 | x11 licen | x11 licen[cs]e
bsd | 50 | bsd licen | bsd licen[cs]e
bsd | 50 | bsd style | bsd style licen[cs]e
bsd | 50 | berkeley software distribution | berkeley software distribution licen[cs]e
isc | 50 | isc licen | isc licen[cs]e
zlib | 50 | zlib | zlib (?:libpng )?licen[cs]e
wtfpl | 50 | wtfpl | wtfpl
unlicense | 50 | the unlicense | the unlicense
bsl | 50 | boost software license | boost software license
artistic | 50 | artistic license | artistic license
mpl | 50 | mozilla public license | mozilla public license
epl | 50 | eclipse public license | eclipse public license
cddl | 50 | common development and distribution | common development and distribution license
cpl | 50 | common public license | common public license
eupl | 50 | european union public | european union public licen[cs]e
afl | 50 | academic free license | academic free license
osl | 50 | open software license | open software license
ms-pl | 50 | microsoft public license | microsoft public license
ms-rl | 50 | microsoft reciprocal license | microsoft reciprocal license
ofl | 50 | open font license | (?:sil )?open font license
odbl | 50 | open database license | open database license
odc-by | 50 | open data commons attribution | open data commons attribution license
pddl | 50 | public domain dedication and license | public domain dedication and license
psf | 50 | python software foundation license | python software foundation license
php | 50 | php license | php license
ruby | 50 | ruby license | ruby license
openssl | 50 | openssl license | openssl license
ncsa | 50 | ncsa open source license | (?:university of illinois )?ncsa open source license
postgresql | 50 | postgresql license | postgresql license
lppl | 50 | latex project public license | latex project public license
gfdl | 50 | free documentation license | (?:gnu )?free documentation license
sspl | 50 | server side public license | server side public license
busl | 50 | business source license | business source license
elastic | 50 | elastic license | elastic license
json | 50 | json license | json license
vim | 50 | vim license | vim license
w3c | 50 | w3c | w3c (?:software notice and )?license
upl | 50 | universal permissive license | universal permissive license
blueoak | 50 | blue oak model license | blue oak model license
cecill | 50 | cecill | cecill(?: [abc])? licen[cs]e
ogl | 50 | open government licence | open government licence
gpl | 50 | general public license | (?:gnu )?general public license
gpl | 50 | gnu gpl | gnu gpl
lgpl | 50 | lesser general public license | (?:gnu )?lesser general public license
lgpl | 50 | library general public license | (?:gnu )?library general public license
lgpl | 50 | gnu lgpl | gnu lgpl
agpl | 50 | affero general public license | (?:gnu )?affero general public license
agpl | 50 | gnu agpl | gnu agpl
cc-by-nc-sa | 50 | cc by | cc by nc sa
cc-by-nc-nd | 50 | cc by | cc by nc nd
cc-by-nc | 50 | cc by | cc by nc
cc-by-nd | 50 | cc by | cc by nd
cc-by-sa | 50 | cc by | cc by sa
cc-by | 50 | cc by | cc by
cc-by-nc-sa | 50 | creative commons | creative commons attribution non ?commercial share ?alike
cc-by-nc-nd | 50 | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
cc-by-nc | 50 | creative commons | creative commons attribution non ?commercial
cc-by-nd | 50 | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: works)?
cc-by-sa | 50 | creative commons | creative commons attribution share ?alike
cc-by | 50 | creative commons | creative commons attribution
cc | 40 | creative commons | creative commons(?: licen[cs]e)?
gpl | 40 | copyleft | copyleft licen[cs]e
proprietary | 40 | proprietary licen | proprietary licen[cs]e
unknown-license | 10 | licensed under | licensed under
unknown-license | 10 | open source licen | open source licen[cs]e
unknown-license | 10 | subject to the terms | subject to the terms of the licen[cs]e
unknown-license | 10 | free software licen | free software licen[cs]e
"""
GENERAL = 10        # rules of this priority yield to any overlapping detection


@cache
def rules() -> tuple[Rule, ...]:
    """All signature rules, highest priority first, in their written order among equals."""
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, priority, gate, body = (part.strip() for part in line.split(" | "))
        body = re.sub(r"UNDER|LATER|YEAR|\bV(?=[0-9])", lambda m: SHORTHANDS[m[0]], body)
        out.append(Rule(label, gate, re.compile(rf"(?<= )(?:{body})(?= )"), int(priority), WEIGHTS[int(priority)]))
    return tuple(sorted(out, key=lambda r: -r.priority))


@cache
def gates():
    """Aho-Corasick automaton of the gate keywords; a keyword's value is the numbers of its rules."""
    import ahocorasick

    by_gate: dict[str, list[int]] = {}
    for i, r in enumerate(rules()):
        by_gate.setdefault(r.gate, []).append(i)
    automaton = ahocorasick.Automaton()
    for gate, numbers in by_gate.items():
        automaton.add_word(gate, tuple(numbers))
    automaton.make_automaton()
    return automaton


def detections(words: str) -> list[tuple[int, int, Rule]]:
    """Taken detections (begin, end in ``words``, rule); ``words`` are blank-joined with a blank at both ends."""
    run = sorted({i for _, numbers in gates().iter(words) for i in numbers})
    found = [(m.start(), m.end(), i) for i in run for m in rules()[i].pattern.finditer(words)]
    found.sort(key=lambda d: (-rules()[d[2]].priority, d[0] - d[1], d[0], d[2]))
    taken: list[tuple[int, int, Rule]] = []
    # taken intervals that lie in no other: begins and ends both rise, so one binary search finds what could hold a new one
    begins: list[int] = []
    ends: list[int] = []
    for begin, end, i in found:
        at = bisect_right(begins, begin)
        if at and ends[at - 1] >= end:
            continue
        if rules()[i].priority <= GENERAL:
            over = bisect_right(ends, begin)                 # the first taken interval that ends after this begins
            if over < len(begins) and begins[over] < end:
                continue
        taken.append((begin, end, rules()[i]))
        low, high = bisect_left(begins, begin), bisect_right(ends, end)      # taken intervals inside the new one
        begins[low:high], ends[low:high] = [begin], [end]
    return taken


def words_of(text: bytes) -> tuple[list[bytes], bytes]:
    """The lower-case words of a UTF-8 text, and the same joined with blanks, one at both ends."""
    parts = [p for p in text.lower().translate(_TO_BLANK).split(b" ") if p]
    return parts, b" " + b" ".join(parts) + b" "


def scan(text: bytes) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one UTF-8 text."""
    parts, joined = words_of(text)
    places, base = [], set()
    for phrase, label in BASE.items():
        needle = f" {phrase} ".encode()
        at = joined.find(needle)
        while at >= 0:
            places.append(at)
            base.add(label)
            at = joined.find(needle, at + 1)
    taken = detections(joined.decode("utf-8", "replace"))
    labels = base | {r.label for _, _, r in taken}
    word = lambda at: joined.count(b" ", 0, at)
    score = max([r.weight for _, _, r in taken] + [0.9] * bool(base), default=0.0)
    return (len(parts), len(places), word(min(places)) if places else None, word(max(places)) if places else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


FIELDS = (("n_words", pa.int64(), T.LongType()), ("n_base", pa.int64(), T.LongType()), ("first_word", pa.int64(), T.LongType()),
          ("last_word", pa.int64(), T.LongType()), ("base_labels", pa.string(), T.StringType()),
          ("labels", pa.string(), T.StringType()), ("score", pa.float64(), T.DoubleType()))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, label, first_word, n_words, weight): every detection that is not suppressed, words from 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, label, first, n, weight = [], [], [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.binary())):
                joined = words_of(text.as_py() or b"")[1].decode("utf-8", "replace")
                blanks = [m.start() for m in re.finditer(" ", joined)]
                for begin, end, rule in detections(joined):
                    row.append(i)
                    label.append(rule.label)
                    first.append(bisect_left(blanks, begin) - 1)
                    n.append(bisect_left(blanks, end) - bisect_left(blanks, begin) + 1)
                    weight.append(rule.weight)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(label, pa.string()), pa.array(first, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(weight, pa.float64())],
                names=["doc_id", "label", "first_word", "n_words", "weight"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("label", T.StringType()),
                           T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("weight", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def scan_documents(docs: DataFrame) -> DataFrame:
    """Contract columns of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            cols = [pa.array([r[i] for r in rows], kind) for i, (_, kind, _) in enumerate(FIELDS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", *[f[0] for f in FIELDS]])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(n, t) for n, _, t in FIELDS])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
