"""License scan: fixed phrases, and ordered signature rules behind a keyword prefilter.

The rules are regular expressions: those written out in ``NOTICES``, and those
made from templates: how licenses are named, granted and tagged, for each
family and version. Words of a rule may stand apart by any run of white space
and comment signs. A text is first tried for the
keywords of any rule, then for the keyword of each rule, and only then for its
expression. A detection inside another one of higher priority, or of the same
priority and longer, is suppressed. Everything runs as expressions on the row.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrase and label of the fixed part.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: What parts the words of a lowered text: every ASCII character but letters and digits.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# License families as (label, names, versions, tags); a name and a tag may be followed by a version.
FAMILIES = [
    ("gpl", ["GNU General Public Licen[sc]e", "GNU GPL", "GPL"], ["1", "2", "3"], ["GPL"]),
    ("lgpl", ["GNU (?:Lesser|Library) General Public Licen[sc]e", "GNU LGPL", "LGPL"], ["2", "2.1", "3"], ["LGPL"]),
    ("agpl", ["GNU Affero General Public Licen[sc]e", "GNU AGPL", "AGPL"], ["1", "3"], ["AGPL"]),
    ("gfdl", ["GNU Free Documentation Licen[sc]e", "GFDL"], ["1.1", "1.2", "1.3"], ["GFDL"]),
    ("apache", ["Apache (?:Software )?Licen[sc]e"], ["1.0", "1.1", "2.0"], ["Apache"]),
    ("mpl", ["Mozilla Public Licen[sc]e", "MPL"], ["1.0", "1.1", "2.0"], ["MPL"]),
    ("epl", ["Eclipse Public Licen[sc]e", "EPL"], ["1.0", "2.0"], ["EPL"]),
    ("eupl", ["European Union Public Licen[sc]e", "EUPL"], ["1.0", "1.1", "1.2"], ["EUPL"]),
    ("cddl", ["Common Development and Distribution Licen[sc]e", "CDDL"], ["1.0", "1.1"], ["CDDL"]),
    ("cpl", ["Common Public Licen[sc]e"], ["1.0"], ["CPL"]),
    ("artistic", ["Artistic Licen[sc]e"], ["1.0", "2.0"], ["Artistic"]),
    ("osl", ["Open Software Licen[sc]e"], ["1.0", "2.0", "2.1", "3.0"], ["OSL"]),
    ("afl", ["Academic Free Licen[sc]e"], ["1.1", "2.0", "2.1", "3.0"], ["AFL"]),
    ("ofl", ["SIL Open Font Licen[sc]e"], ["1.0", "1.1"], ["OFL"]),
    ("psf", ["Python Software Foundation Licen[sc]e", "PSF Licen[sc]e"], ["2"], ["PSF", "Python"]),
    ("php", ["PHP Licen[sc]e"], ["3.0", "3.01"], ["PHP"]),
    ("zpl", ["Zope Public Licen[sc]e"], ["1.1", "2.0", "2.1"], ["ZPL"]),
    ("ms-pl", ["Microsoft Public Licen[sc]e"], [], ["MS-PL"]),
    ("ms-rl", ["Microsoft Reciprocal Licen[sc]e"], [], ["MS-RL"]),
    ("mit", ["MIT Licen[sc]e", "MIT/X11 Licen[sc]e", "Expat Licen[sc]e", "X11 Licen[sc]e"], [], ["MIT"]),
    ("isc", ["ISC Licen[sc]e"], [], ["ISC"]),
    ("zlib", ["zlib Licen[sc]e", "zlib/libpng Licen[sc]e"], [], ["Zlib"]),
    ("boost", ["Boost Software Licen[sc]e"], ["1.0"], ["BSL"]),
    ("bsd", ["(?:Berkeley|BSD)(?:[ -]style)? Licen[sc]e"], [], ["BSD"]),
    ("bsd-2-clause", ["(?:2|two)[ -]clause BSD", "Simplified BSD", "FreeBSD Licen[sc]e", "BSD[ -]2[ -]clause"], [], ["BSD-2-Clause"]),
    ("bsd-3-clause", ["(?:3|three)[ -]clause BSD", "(?:New|Modified|Revised) BSD", "BSD[ -]3[ -]clause"], [], ["BSD-3-Clause"]),
    ("bsd-4-clause", ["(?:4|four)[ -]clause BSD", "BSD[ -]4[ -]clause"], [], ["BSD-4-Clause"]),
    ("unlicense", ["The Unlicen[sc]e"], [], ["Unlicense"]),
    ("wtfpl", ["Do What The F\\w+ You Want To Public Licen[sc]e", "WTFPL"], ["2"], ["WTFPL"]),
    ("postgresql", ["PostgreSQL Licen[sc]e"], [], ["PostgreSQL"]),
    ("openssl", ["OpenSSL Licen[sc]e"], [], ["OpenSSL"]),
    ("odbl", ["Open (?:Data Commons )?(?:Open )?Database Licen[sc]e", "ODbL"], ["1.0"], ["ODbL"]),
    ("pddl", ["Public Domain Dedication and Licen[sc]e"], ["1.0"], ["PDDL"]),
]
CC_PARTS = {"by": "Attribution", "sa": "Share[ -]?Alike", "nc": "Non[ -]?Commercial", "nd": "No[ -]?Derivat(?:ives|ive Works|es|s)"}
CC_KINDS = [("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd")]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
GRANTS = {
    "mit": ["Permission is hereby granted,? free of charge,? to any person obtaining a copy"],
    "isc": ["Permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose with or without fee"],
    "bsd": ["Redistributions? and use in source and binary forms,? with or without modification"],
    "zlib": ["This software is provided '?as-is'?,? without any express or implied warranty"],
    "gpl": ["This program is free software[:;,]? you can redistribute it and/or modify it under the terms of the GNU General Public Licen[sc]e"],
    "lgpl": ["This library is free software[:;,]? you can redistribute it"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "public-domain": ["(?:released|dedicated|placed) (?:in)?to the public domain", "(?:is|are) in the public domain"],
    "cc0": ["CC0", "CC Zero", "No Rights Reserved"],
    "proprietary": ["All rights reserved", "(?:strictly )?confidential and proprietary", "may not be (?:copied|reproduced|redistributed) without"],
}
#: Acronyms that are also read in lower case or glued to their version, as in "gpl v3" and "LGPLv2.1".
ACRONYMS = [("gpl", ["1", "2", "3"]), ("lgpl", ["2", "2.1", "3"]), ("agpl", ["1", "3"]), ("mpl", ["1.1", "2.0"]), ("epl", ["1.0", "2.0"]), ("eupl", ["1.1", "1.2"]), ("cddl", ["1.0", "1.1"]), ("gfdl", ["1.2", "1.3"])]

# Wordings of notices and texts, as (label, wording, words that each match holds, priority).
NOTICES = [
    ("mit", "(?:licen[sc]ed|released|distributed|available) under MIT", "under mit", 2),
    ("mit", "(?:licen[sc]ed|released|distributed|available) under the MIT", "under the mit", 2),
    ("mit", "(?:licen[sc]ed|released|distributed|available) under either MIT", "under either mit", 2),
    ("mit", "(?:licen[sc]ed|released|distributed|available) under both MIT", "under both mit", 2),
    ("mit", "(?:licen[sc]ed|released|distributed|available) under either the MIT", "under either the mit", 2),
    ("mit", "MIT or Apache", "mit or apache", 2),
    ("mit", "MIT/Apache", "mit apache", 2),
    ("mit", "MIT and Apache", "mit and apache", 2),
    ("mit", "Apache or MIT", "apache or mit", 2),
    ("mit", "Apache[ -]2 or MIT", "apache 2 or mit", 2),
    ("mit", "Apache[ -]2\\.0 or MIT", "apache 2 0 or mit", 2),
    ("mit", "license: MIT", "license mit", 2),
    ("mit", "licence: MIT", "licence mit", 2),
    ("mit", "to deal in the Software without restriction,? including without limitation the rights to use,? copy,? modify,? merge,? publish", "to deal in the software without restriction", 2),
    ("mit", "The above copyright notice and this permission notice(?: \\(including the next paragraph\\))? shall be included in all copies or substantial portions", "copies or substantial portions", 2),
    ("mit", "THE SOFTWARE IS PROVIDED \"?AS IS\"?,? WITHOUT WARRANTY OF ANY KIND,? EXPRESS OR IMPLIED,? INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,? FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT", "and noninfringement", 2),
    ("mit-0", "MIT No Attribution", "mit no attribution", 3),
    ("x11", "Except as contained in this notice,? the name", "except as contained in this notice", 2),
    ("apache-2.0", "Apache-2\\.0", "apache 2 0", 3),
    ("apache-2.0", "Apache 2(?:\\.0)? licen[sc]e", "apache 2", 3),
    ("apache-2.0", "Apache v2(?:\\.0)?", "apache v2", 3),
    ("apache-2.0", "Apache Licen[sc]e,? 2(?:\\.0)?", "apache licen", 3),
    ("apache-2.0", "ASL[ -]?2(?:\\.0)?", "asl 2", 3),
    ("apache-2.0", "www\\.apache\\.org/licenses/LICENSE-2\\.0", "apache org licenses license 2 0", 4),
    ("apache-1.1", "This product includes software developed by the Apache Software Foundation", "developed by the apache software foundation", 2),
    ("apache", "licen[sc]ed to the Apache Software Foundation \\(?ASF\\)? under one or more contributor licen[sc]e agreements", "to the apache software foundation", 2),
    ("gpl-2-or-later", "GNU General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 2 of the Licen[sc]e,? or \\(?at your option\\)? any later version", "either version 2 of the", 4),
    ("gpl-3-or-later", "GNU General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 3 of the Licen[sc]e,? or \\(?at your option\\)? any later version", "either version 3 of the", 4),
    ("gpl-1-or-later", "GNU General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 1,? or \\(?at your option\\)? any later version", "either version 1", 4),
    ("gpl-2", "GNU General Public Licen[sc]e(?: as published by the Free Software Foundation)?[;,.:]? version 2(?: of the Licen[sc]e)?", "version 2", 3),
    ("gpl-3", "GNU General Public Licen[sc]e(?: as published by the Free Software Foundation)?[;,.:]? version 3(?: of the Licen[sc]e)?", "version 3", 3),
    ("gpl-2", "GNU General Public Licen[sc]e version 2 as published by the Free Software Foundation", "version 2 as published by the free software foundation", 3),
    ("gpl-3", "GNU General Public Licen[sc]e version 3 as published by the Free Software Foundation", "version 3 as published by the free software foundation", 3),
    ("lgpl-2-or-later", "GNU (?:Lesser|Library) General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 2 of the Licen[sc]e,? or \\(?at your option\\)? any later version", "either version 2 of the", 4),
    ("lgpl-2.1-or-later", "GNU (?:Lesser|Library) General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 2\\.1 of the Licen[sc]e,? or \\(?at your option\\)? any later version", "either version 2 1 of the", 4),
    ("lgpl-3-or-later", "GNU (?:Lesser|Library) General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 3 of the Licen[sc]e,? or \\(?at your option\\)? any later version", "either version 3 of the", 4),
    ("lgpl-2.1", "GNU (?:Lesser|Library) General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? version 2\\.1", "foundation version 2 1", 3),
    ("agpl-3-or-later", "GNU Affero General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? either version 3 of the Licen[sc]e,? or \\(?at your option\\)? any later version", "either version 3 of the", 4),
    ("agpl-3", "GNU Affero General Public Licen[sc]e as published by the Free Software Foundation[;,.:]? version 3", "foundation version 3", 3),
    ("gpl", "You should have received a copy of the GNU General Public Licen[sc]e along with this program", "received a copy of the gnu general public", 2),
    ("gpl", "GNU GENERAL PUBLIC LICENSE Version \\d, \\d+ [A-Z][a-z]+ \\d{4}", "gnu general public license version", 2),
    ("lgpl", "You should have received a copy of the GNU (?:Lesser|Library) General Public Licen[sc]e along with this (?:library|program)", "received a copy of the gnu l", 2),
    ("agpl", "You should have received a copy of the GNU Affero General Public Licen[sc]e along with this program", "received a copy of the gnu affero", 2),
    ("gpl-classpath-exception", "Linking this library statically or dynamically with other modules is making a combined work", "linking this library statically or dynamically", 3),
    ("gfdl", "Permission is granted to copy,? distribute and/or modify this document under the terms of the GNU Free Documentation Licen[sc]e", "modify this document under the terms of the gnu free documentation", 2),
    ("bsd-2-clause", "Redistributions of source code must retain the above copyright notice,? this list of conditions and the following disclaimer", "redistributions of source code must retain the above copyright", 2),
    ("bsd-3-clause", "Neither the names? of [^.]{1,200} nor the names of (?:its|their|any) contributors may be used to endorse or promote products", "contributors may be used to endorse or promote products", 3),
    ("bsd-4-clause", "All advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising materials mentioning features or use of this software", 3),
    ("bsd", "BSD-style licen[sc]e that can be found in the LICENSE file", "bsd style licen", 2),
    ("0bsd", "Zero[ -]Clause BSD", "zero clause bsd", 3),
    ("isc", "Permission to use,? copy,? modify,? and(?:/or)? distribute this software(?: and its documentation)? for any purpose with or without fee is hereby granted", "with or without fee is hereby granted", 2),
    ("mpl-1.1", "subject to the Mozilla Public Licen[sc]e Version 1\\.1", "subject to the mozilla public licen", 4),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public Licen[sc]e,? v\\. 2\\.0", "this source code form is subject to the terms of the mozilla", 4),
    ("mpl-2.0", "mozilla\\.org/MPL/2\\.0", "mozilla org mpl 2 0", 4),
    ("epl-1.0", "eclipse\\.org/legal/epl-v10", "eclipse org legal epl v10", 4),
    ("epl-2.0", "eclipse\\.org/legal/epl-(?:v20|2\\.0)", "eclipse org legal epl", 4),
    ("cddl", "subject to the terms of the Common Development and Distribution Licen[sc]e", "subject to the terms of the common development", 2),
    ("boost-1.0", "Permission is hereby granted,? free of charge,? to any person or organization obtaining a copy of the software and accompanying documentation", "to any person or organization obtaining a copy", 3),
    ("boost-1.0", "boost\\.org/LICENSE_1_0\\.txt", "boost org license 1 0 txt", 4),
    ("zlib", "Altered source versions must be plainly marked as such,? and must not be misrepresented as being the original software", "altered source versions must be plainly marked as such", 3),
    ("json", "The Software shall be used for Good,? not Evil", "shall be used for good not evil", 3),
    ("beerware", "THE BEER-?WARE LICEN[SC]E", "the beer", 3),
    ("wtfpl", "YOU JUST DO WHAT THE F\\w+ YOU WANT TO", "you just do what the f", 3),
    ("unlicense", "unlicense\\.org", "unlicense org", 2),
    ("unlicense", "Anyone is free to copy,? modify,? publish,? use,? compile,? sell,? or distribute this software", "anyone is free to copy modify publish use compile sell", 3),
    ("cc0", "To the extent possible under law,? [^.]{1,200} waived all copyright and related or neighbou?ring rights", "to the extent possible under law", 3),
    ("cc0-1.0", "creativecommons\\.org/publicdomain/zero/1\\.0", "creativecommons org publicdomain zero", 5),
    ("public-domain", "creativecommons\\.org/publicdomain/mark/1\\.0", "creativecommons org publicdomain mark", 5),
    ("artistic", "under the same terms as Perl itself", "under the same terms as perl itself", 2),
    ("gpl", "under the same terms as Perl itself", "under the same terms as perl itself", 2),
    ("ofl-1.1", "This Font Software is licen[sc]ed under the SIL Open Font Licen[sc]e,? Version 1\\.1", "this font software is licensed under the sil", 4),
    ("python-2", "PSF LICENSE AGREEMENT FOR PYTHON", "license agreement for python", 3),
    ("ijg", "This software is based in part on the work of the Independent JPEG Group", "work of the independent jpeg group", 2),
    ("openssl", "This product includes software developed by the OpenSSL Project", "software developed by the openssl project", 3),
    ("ssleay", "This product includes cryptographic software written by Eric Young", "cryptographic software written by eric young", 3),
    ("curl", "licen[sc]ed as described in the file COPYING,? which you should have received as part of this distribution", "licensed as described in the file copying", 2),
    ("ncsa", "University of Illinois/NCSA Open Source Licen[sc]e", "illinois ncsa open source licen", 3),
    ("sspl-1.0", "Server Side Public Licen[sc]e", "server side public licen", 3),
    ("busl-1.1", "Business Source Licen[sc]e", "business source licen", 3),
    ("elastic-2.0", "Elastic Licen[sc]e 2\\.0", "elastic licen", 3),
    ("commons-clause", "Commons Clause Licen[sc]e Condition", "commons clause licen", 3),
    ("cecill", "CeCILL(?:-[BC])?", "cecill", 2),
    ("upl-1.0", "Universal Permissive Licen[sc]e", "universal permissive licen", 3),
    ("mulan-psl-2.0", "Mulan PSL v2", "mulan psl v2", 4),
    ("vim", "Vim Licen[sc]e", "vim licen", 2),
    ("ecl-2.0", "Educational Community Licen[sc]e,? Version 2\\.0", "educational community licen", 3),
    ("hpnd", "supporting documentation,? and that the name of [^.]{1,200} not be used in advertising or publicity", "not be used in advertising or publicity", 2),
    ("ogl-3.0", "Open Government Licen[sc]e v(?:ersion )?3\\.0", "open government licen", 3),
    ("cc-by-sa-3.0", "Text is available under the Creative Commons Attribution-ShareAlike", "text is available under the creative commons attribution", 2),
]
LEADS = "(?:licen[sc]ed|released|distributed|available|published|covered|provided|made available)(?: to you)?(?: under| by|:)(?: the)?(?: terms of(?: the)?)? "

#: Edges of words as GAP has them, in either case.
LEFT, RIGHT = (rf"(?{look}[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])" for look in ("<!", "!"))
SIGNS = r"\s*#/,;:%!|>\"'-"
SPACE = rf"[{SIGNS}]++"
#: Between a name and its number: any run with a word for version, else a few signs.
VERSION = rf"(?i:[{SIGNS}(]*+(?:version|ver\.?|v\.?)[{SIGNS}]*+|[\s,;(-]{{0,4}})"


def _spaced(pattern: str) -> str:
    return pattern.replace("[ -]", "[\\s-]").replace(" ", SPACE)


def rules() -> list[dict]:
    """The rules in order: label, expression, keyword that a text must hold, priority, confidence.

    A named version outranks a name, a tag outranks both, and a lead such as
    "licensed under the" outranks the bare name. Acronyms keep their case.
    """
    out: list[dict] = []

    def add(label: str, expression: str, keyword: str, priority: int, confidence: float) -> None:
        out.append({"label": label, "expression": expression, "keyword": keyword, "priority": priority, "confidence": confidence})

    later = rf"(?i:\+|{SPACE}or{SPACE}(?:\(?at{SPACE}your{SPACE}option\)?{SPACE})?(?:any{SPACE})?(?:later|newer|greater))"
    for label, names, versions, tags in FAMILIES:
        for name in names:
            word = _keyword(name)
            body = rf"{LEFT}{_spaced(name)}{RIGHT}" if name.isupper() else rf"{LEFT}(?i:{_spaced(name)}){RIGHT}"
            for v in versions:
                number = v.replace(".", r"\.") + ("" if "." in v else r"(?:\.0)?")
                add(f"{label}-{v}", rf"{body}{VERSION}{number}(?![.]?\d)", word, 3, 0.95)
                add(f"{label}-{v}-or-later", rf"{body}{VERSION}{number}{later}", word, 4, 0.97)
            add(label, rf"(?i:{_spaced(LEADS)}){body}", word, 2, 0.9)
            if not name.isupper():
                add(label, body, word, 1, 0.7)
        for tag in tags:
            for v in versions or [""]:
                number = "-" + v.replace(".", r"\.") + ("" if "." in v else r"(?:\.0)?") if v else ""
                name = f"{label}-{v}" if v else label
                # The first tag of an expression, or one after AND, OR or a bracket, in its own case there.
                for lead in (rf"(?i:SPDX-License-Identifier:[\s(]{{0,8}}{tag})", rf"(?:AND|OR)[ \t(]++{tag}"):
                    add(name, rf"{lead}{number}(?:-only)?(?![\w+-]|\.\w)", "spdx license identifier", 5, 1.0)
                    if v:
                        add(f"{name}-or-later", rf"{lead}{number}(?:-or-later|\+)(?![\w-])", "spdx license identifier", 5, 1.0)
    for kind in CC_KINDS:
        label = "cc-" + "-".join(kind)
        short, names = "CC" + "".join(rf"[\s-]{k}" for k in kind), r"[\s,-]{1,4}".join(CC_PARTS[k] for k in kind)
        for v in CC_VERSIONS:
            number = v.replace(".", r"\.")
            add(f"{label}-{v}", rf"(?i){LEFT}{short}[\s-]{{1,2}}v?{number}(?!\d)", "cc by", 3, 0.95)
            add(f"{label}-{v}", rf"(?i){LEFT}Creative{SPACE}Commons{SPACE}{names}[\s,-]{{1,4}}(?:v|version{SPACE})?{number}(?!\d)", "creative commons attribution", 4, 0.97)
            add(f"{label}-{v}", rf"(?i)creativecommons\.org/licenses/{'-'.join(kind)}/{number}(?!\d)", "creativecommons org licenses", 5, 1.0)
            add(f"{label}-{v}", rf"(?i)SPDX-License-Identifier:\s{{0,4}}\(?CC-{'-'.join(kind)}-{number}(?![\w.-])", "spdx license identifier", 5, 1.0)
        add(label, rf"(?i){LEFT}{short}(?![\w-])", "cc by", 2, 0.8)
        add(label, rf"(?i){LEFT}Creative{SPACE}Commons{SPACE}{names}{RIGHT}", "creative commons attribution", 2, 0.85)
    for acronym, versions in ACRONYMS:
        for v in versions:
            major, _, minor = v.partition(".")
            number = major + (rf"\.{minor}" if minor else r"(?:\.0)?")
            forms = [(rf"v{number}", f"{acronym}v{major}"), (rf"{SPACE}v(?:ersion{SPACE})?{number}", f"{acronym} v"), (rf"{SPACE}{major}\.{minor or 0}", f"{acronym} {major} {minor or 0}")]
            for form, word in forms:
                add(f"{acronym}-{v}", rf"(?i){LEFT}{acronym}{form}(?![.]?\d)", word, 3, 0.95)
                add(f"{acronym}-{v}-or-later", rf"(?i){LEFT}{acronym}{form}{later}", word, 4, 0.97)
    for label, wording, keyword, priority in NOTICES:
        add(label, rf"(?i){LEFT}{_spaced(wording)}{RIGHT}", keyword, priority, 0.9)
    for label, grants in GRANTS.items():
        for grant in grants:
            body = rf"{LEFT}{_spaced(grant)}{RIGHT}" if grant.isupper() else rf"(?i){LEFT}{_spaced(grant)}{RIGHT}"
            add(label, body, _keyword(grant), 1 if label in ("proprietary", "public-domain") else 2, 0.85)
    return out


def _keyword(pattern: str) -> str:
    """The longest run of whole letters, digits and spaces that each match holds, "license" itself last.

    In lower case it is looked for in the lowered words of a text; an acronym is looked for as it stands.
    """
    runs, run, depth, k = [], "", 0, 0
    pattern = pattern.replace("[ -]", " ").replace("/", " ")
    while k < len(pattern):
        c = pattern[k]
        depth += c in "(["
        if depth == 0 and (c.isalnum() or c == " ") and pattern[k + 1 : k + 2] not in ("?", "*"):
            run += c
        else:
            runs, run = [*runs, run], ""
        depth -= c in ")]"
        k += 1
    runs = [r.strip() for r in [*runs, run]]
    if pattern.isupper():
        runs = [w for r in runs for w in r.split()]
        return max(runs, key=lambda w: (w != "GNU", len(w)))
    return max(runs, key=lambda r: (len(r) > 2 and r not in ("Licen", "Public Licen"), len(r))).lower()


RULES = rules()
KEYWORDS = sorted({r["keyword"] for r in RULES})
#: A text without any of these holds no keyword: those of the keywords that contain no other one.
ROOTS = [k for k in KEYWORDS if not any(o != k and o in k for o in KEYWORDS)]
RULE_TYPE = "array<struct<place:int,label:string,expression:string,keyword:string,priority:int,confidence:double>>"
PRIORITIES = max(r["priority"] for r in RULES)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where it is used inside a function over an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _places(words: Column) -> dict[str, Column]:
    """Per phrase ``(n, first, last)`` in lowered words that have a space on either side each."""
    out = {}
    spaces = lambda c: ((F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("long")
    n_words = spaces(words)
    for phrase in PHRASES:
        parts = phrase.split()
        pieces = F.split(words, "".join(f" {p} " for p in parts), -1)
        n = (F.size(pieces) - 1).cast("long")
        first, last = spaces(F.element_at(pieces, 1)), n_words - spaces(F.element_at(pieces, -1)) - len(parts)
        out[phrase] = F.when(n > 0, F.struct(n.alias("n"), first.alias("first"), last.alias("last")))
    return out


def _detections(text: Column, words: Column) -> Column:
    """``array<struct<start, end, priority, label, confidence>>`` of the rules, by start, longest and highest first."""
    table = F.from_json(F.lit(json.dumps([r | {"place": k} for k, r in enumerate(RULES)])), RULE_TYPE)

    def matches(rule: Column) -> Column:
        return _let(F.regexp_extract_all(text, rule["expression"], F.lit(0)), lambda hits: located(rule, hits))

    def located(rule: Column, hits: Column) -> Column:
        gaps = F.split(text, rule["expression"], -1)
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("found"))

        def step(done: Column, pair: Column) -> Column:
            begin = done["at"] + F.length(pair["g"])
            end = begin + F.length(pair["h"])
            return F.struct(end.cast("long").alias("at"), F.concat(done["found"], F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))).alias("found"))

        pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("g"), hits.alias("h"))
        found = F.when(F.size(hits) > 0, F.aggregate(pairs, start, step)["found"]).otherwise(F.array().cast("array<struct<start:long,end:long>>"))
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("back"), (-rule["priority"]).alias("rank"), rule["place"].alias("place"), rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    held_by = lambda hay: F.filter(F.array(*[F.lit(k) for k in KEYWORDS]), lambda k: hay.contains(k))
    present = _let(F.concat(words, F.lit("\n"), text), held_by)
    gated = _let(present, lambda held: F.filter(table, lambda r: F.array_contains(held, r["keyword"])))
    return F.array_sort(F.flatten(F.transform(gated, matches)))


def _kept(detections: Column) -> Column:
    """``(labels, score)`` of the detections that no stronger one contains, in one pass by start.

    ``reach[p]`` is the furthest end so far of detections of priority ``p`` or
    more. Of equal stretches, those of the highest priority, then the earliest
    rule, come first.
    """
    begin = F.struct(F.array(*[F.lit(-1).cast("long")] * PRIORITIES).alias("reach"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))

    def step(done: Column, d: Column) -> Column:
        end, priority = -d["back"], -d["rank"]
        hidden = F.element_at(done["reach"], priority) >= end
        reach = F.transform(done["reach"], lambda r, i: F.when((i < priority) & (r < end), end).otherwise(r))
        return F.struct(
            reach.alias("reach"),
            F.when(hidden, done["labels"]).otherwise(F.array_union(done["labels"], F.array(d["label"]))).alias("labels"),
            F.when(hidden, done["score"]).otherwise(F.greatest(done["score"], d["confidence"])).alias("score"),
        )

    return F.aggregate(detections, begin, step)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__scan``: the fields that ``query`` returns.

    A null or empty text has no words, places or labels and scores 0. Other
    columns pass through; rows are independent, so ties and copies do not matter.
    """
    text, words = F.col("__text"), F.col("__words")
    out = docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    # Lowering more than A-Z changes no word into one of the phrases.
    out = out.withColumn("__words", F.trim(F.regexp_replace(F.lower(text), GAP, " ")))
    gate = reduce(or_, [(words if k == k.lower() else text).contains(k) for k in ROOTS])
    spaced = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    near = reduce(or_, [words.contains(p) for p in PHRASES])
    out = out.withColumn("__spaced", F.when(near, spaced)).withColumn("__rules", F.when(gate, _kept(_detections(text, words))))
    out = out.withColumn("__places", F.when(F.col("__spaced").isNotNull(), F.array(*_places(F.col("__spaced")).values())))
    n_words = F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("long")
    places = F.coalesce(F.array_compact("__places"), F.array().cast("array<struct<n:long,first:long,last:long>>"))
    labels = [F.when(F.col("__places")[i].isNotNull(), F.lit(label)) for i, label in enumerate(PHRASES.values())]
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    every = F.array_sort(F.array_union(base, F.coalesce(F.col("__rules.labels"), F.array().cast("array<string>"))))
    result = F.struct(
        n_words.alias("n_words"),
        F.aggregate(F.transform(places, lambda p: p["n"]), F.lit(0).cast("long"), lambda a, b: a + b).alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["last"])).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.coalesce(F.col("__rules.score"), F.lit(0.0)).alias("score"),
    )
    return out.withColumn("__scan", result).drop("__text", "__words", "__spaced", "__places", "__rules")


def query(spark, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return scan(docs).select("doc_id", "__scan.*")
