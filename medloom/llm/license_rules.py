"""Signatures of licences: hand-written patterns over normalised words, with keywords, priorities and confidences.

A text is reduced to its words (ASCII letters in lower case, digits, every non-ASCII character), one space apart; the
patterns are written for that form, so "Version 2.0," reads "version 2 0".  In a pattern ``{v}`` stands for each of the
family's versions in turn, and in a label too, where a whole number gets a zero: "gpl 2" and "gpl 2 0" are one licence.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    #: Every one of these must occur in the text for the pattern to be tried.
    keywords: tuple[str, ...]
    priority: int
    confidence: float


#: label, versions, keyword(s), priority (less is stronger), confidence, patterns.
FAMILIES = [
    ("apache-{v}", ("1 0", "1 1", "2 0"), ("apache",), 10, 0.95, [
        r"licensed under the apache (?:software )?license (?:version )?v?{v}", r"apache (?:software )?license (?:version )?v?{v}", r"spdx license identifier apache {v}",
        r"apache org licenses license {v}", r"under the terms of the apache license (?:version )?{v}", r"apache {v} licen[sc]e[d]?",
    ]),
    ("apache-2.0", ("",), ("apache",), 30, 0.8, [r"licensed under the apache licen[sc]e", r"apache software foundation licen[sc]e"]),
    ("apache-2.0", ("",), ("asl",), 30, 0.8, [r"asl ?2(?: 0)?"]),
    ("apache", ("",), ("apache",), 50, 0.6, [r"apache(?: software)? licen[sc]e"]),
    ("mit", ("",), ("mit", "licen"), 10, 0.9, [
        r"(?:released|licensed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit(?: x11)? licen[sc]e", r"spdx license identifier mit", r"mit(?: expat)? licen[sc]e",
        r"opensource org licenses mit", r"licen[sc]e mit", r"dual licensed under (?:the )?mit",
    ]),
    ("mit", ("",), ("permission", "free of charge"), 15, 0.95, [
        r"permission is hereby granted free of charge to any person obtaining a copy",
    ]),
    ("mit", ("",), ("permission notice",), 15, 0.95, [r"the above copyright notice and this permission notice shall be included in all copies"]),
    ("mit", ("",), ("without restriction",), 15, 0.95, [r"to deal in the software without restriction"]),
    ("x11", ("",), ("x11", "licen"), 20, 0.8, [r"x11 licen[sc]e", r"spdx license identifier x11"]),
    ("gpl-{v}", ("1", "2", "3", "1 0", "2 0", "3 0"), ("gpl",), 10, 0.95, [
        r"spdx license identifier gpl {v}(?: only)?", r"gnu gpl (?:version |v)?{v}", r"gpl (?:version |v)?{v}", r"gnu org licenses gpl {v}",
    ]),
    ("gpl-{v}", ("1", "2", "3", "2 0", "3 0"), ("general public license",), 12, 0.95, [
        r"(?:licensed|distributed|released) under the (?:terms of the )?gnu general public license (?:as published by the free software foundation )?(?:version|v) ?{v}",
        r"gnu general public license (?:version|v) ?{v}", r"general public license (?:version|v) ?{v}",
    ]),
    ("gpl-{v}-or-later", ("1", "2", "3", "2 0", "3 0"), ("gpl",), 8, 0.95, [r"gpl {v} or later", r"spdx license identifier gpl {v} or later"]),
    ("gpl-{v}-or-later", ("1", "2", "3"), ("general public license",), 8, 0.95, [r"general public license (?:version )?{v} or (?:at your option )?any later version", r"either version {v} of the licen[sc]e or at your option any later version"]),
    ("gpl-{v}", ("1", "2", "3"), ("gplv{v}",), 9, 0.95, [r"gplv{v}"]),
    ("lgpl-{v}", ("2", "3"), ("lgplv{v}",), 6, 0.95, [r"lgplv{v}"]),
    ("agpl-{v}", ("3",), ("agplv{v}",), 6, 0.95, [r"agplv{v}"]),
    ("gpl", ("",), ("general public license",), 40, 0.8, [
        r"(?:licensed|distributed|released) under the (?:terms of the )?gnu general public license", r"gnu general public license", r"general public license",
        r"redistribute it and or modify it under the terms of the gnu general public license",
    ]),
    ("gpl", ("",), ("gpl",), 45, 0.7, [r"gnu gpl", r"gpl licen[sc]ed?", r"under the gpl"]),
    ("lgpl-{v}", ("2", "2 0", "2 1", "3", "3 0"), ("lgpl",), 6, 0.95, [r"spdx license identifier lgpl {v}(?: only| or later)?", r"lgpl ?v?{v}", r"gnu lgpl (?:version |v)?{v}", r"gnu org licenses lgpl {v}"]),
    ("lgpl-{v}", ("2", "2 1", "3"), ("general public license",), 6, 0.95, [r"gnu (?:lesser|library) general public license (?:version|v) ?{v}", r"(?:lesser|library) general public license (?:version|v) ?{v}"]),
    ("lgpl", ("",), ("general public license",), 20, 0.85, [r"(?:gnu )?(?:lesser|library) general public license"]),
    ("lgpl", ("",), ("lgpl",), 25, 0.75, [r"gnu lgpl", r"lgpl licen[sc]ed?", r"under the lgpl"]),
    ("agpl-{v}", ("1", "1 0", "3", "3 0"), ("agpl",), 6, 0.95, [r"spdx license identifier agpl {v}(?: only| or later)?", r"agpl ?v?{v}", r"gnu org licenses agpl {v}"]),
    ("agpl-{v}", ("1", "3"), ("affero",), 6, 0.95, [r"(?:gnu )?affero general public license (?:version|v) ?{v}"]),
    ("agpl", ("",), ("affero",), 20, 0.85, [r"(?:gnu )?affero general public license"]),
    ("gfdl-{v}", ("1 1", "1 2", "1 3"), ("free documentation",), 10, 0.95, [r"(?:gnu )?free documentation license (?:version |v)?{v}"]),
    ("gfdl-{v}", ("1 1", "1 2", "1 3"), ("gfdl",), 10, 0.95, [r"gfdl {v}"]),
    ("gfdl", ("",), ("free documentation",), 30, 0.8, [r"(?:gnu )?free documentation license"]),
    ("mpl-{v}", ("1 0", "1 1", "2 0"), ("mozilla public",), 10, 0.95, [
        r"mozilla public license (?:version |v )?{v}", r"subject to the terms of the mozilla public license v(?:ersion)? ?{v}",
    ]),
    ("mpl-{v}", ("1 0", "1 1", "2 0"), ("mozilla org",), 10, 0.95, [r"mozilla org (?:mpl|media mpl) {v}"]),
    ("mpl-{v}", ("1 0", "1 1", "2 0"), ("mpl",), 12, 0.9, [r"spdx license identifier mpl {v}", r"mpl ?v?{v}"]),
    ("mpl", ("",), ("mozilla public",), 30, 0.8, [r"mozilla public license"]),
    ("epl-{v}", ("1 0", "2 0"), ("eclipse",), 10, 0.95, [r"eclipse public license (?:version |v ?)?{v}", r"eclipse org legal epl v{v}"]),
    ("epl-{v}", ("1 0", "2 0"), ("spdx license identifier epl",), 10, 0.95, [r"spdx license identifier epl {v}"]),
    ("epl", ("",), ("eclipse",), 30, 0.8, [r"eclipse public license"]),
    ("edl-1.0", ("",), ("eclipse",), 20, 0.85, [r"eclipse distribution license"]),
    ("cddl-{v}", ("1 0", "1 1"), ("cddl",), 10, 0.9, [r"cddl (?:version |v)?{v}", r"spdx license identifier cddl {v}"]),
    ("cddl", ("",), ("development and distribution",), 20, 0.9, [r"common development and distribution license"]),
    ("cpl-1.0", ("",), ("common public",), 20, 0.85, [r"common public license(?: version| v)?(?: 1 0)?"]),
    ("eupl-{v}", ("1 0", "1 1", "1 2"), ("eupl",), 10, 0.9, [r"eupl (?:version |v)?{v}", r"spdx license identifier eupl {v}"]),
    ("eupl", ("",), ("european union public",), 20, 0.85, [r"european union public licen[sc]e"]),
    ("bsd-{v}-clause", ("0", "1", "2", "3", "4"), ("bsd",), 10, 0.9, [r"bsd {v} clause", r"{v} clause bsd", r"spdx license identifier bsd {v} clause", r"opensource org licenses bsd {v} clause"]),
    ("bsd-2-clause", ("",), ("bsd",), 15, 0.9, [r"simplified bsd licen[sc]e", r"two clause bsd"]),
    ("bsd-2-clause", ("",), ("freebsd",), 15, 0.9, [r"freebsd licen[sc]e"]),
    ("bsd-3-clause", ("",), ("bsd",), 15, 0.9, [r"(?:new|modified|revised) bsd licen[sc]e", r"three clause bsd"]),
    ("bsd-4-clause", ("",), ("bsd",), 15, 0.9, [r"(?:original|old) bsd licen[sc]e", r"four clause bsd"]),
    ("bsd-3-clause", ("",), ("endorse",), 12, 0.9, [r"neither the name of [^\n]{1,120}? may be used to endorse or promote products", r"names? of [^\n]{1,80}? contributors may be used to endorse or promote products"]),
    ("bsd-4-clause", ("",), ("advertising materials",), 10, 0.9, [r"all advertising materials mentioning features or use of this software must display"]),
    ("bsd", ("",), ("redistribution",), 40, 0.8, [
        r"redistribution and use in source and binary forms with or without modification are permitted", r"redistributions of source code must retain the above copyright notice",
        r"redistributions in binary form must reproduce the above copyright notice",
    ]),
    ("bsd", ("",), ("bsd",), 45, 0.7, [r"bsd(?: style)? licen[sc]e", r"licensed under (?:the )?bsd"]),
    ("isc", ("",), ("isc", "licen"), 15, 0.85, [r"isc licen[sc]e", r"spdx license identifier isc"]),
    ("isc", ("",), ("permission to use",), 20, 0.85, [r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"]),
    ("zlib", ("",), ("zlib",), 20, 0.8, [r"zlib(?: libpng)? licen[sc]e", r"spdx license identifier zlib"]),
    ("zlib", ("",), ("as is", "express or implied"), 25, 0.8, [r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"]),
    ("libpng", ("",), ("libpng",), 30, 0.7, [r"libpng licen[sc]e"]),
    ("bsl-1.0", ("",), ("boost",), 15, 0.9, [r"boost software license(?: version)?(?: 1 0)?", r"boost org license 1 0 txt"]),
    ("bsl-1.0", ("",), ("spdx license identifier bsl",), 15, 0.9, [r"spdx license identifier bsl 1 0"]),
    ("unlicense", ("",), ("unlicense",), 15, 0.9, [r"the unlicense", r"unlicense org", r"spdx license identifier unlicense"]),
    ("unlicense", ("",), ("public domain",), 18, 0.85, [r"this is free and unencumbered software released into the public domain"]),
    ("wtfpl", ("",), ("wtfpl",), 15, 0.9, [r"wtfpl(?: version)?(?: 2)?"]),
    ("beerware", ("",), ("beer",), 25, 0.7, [r"beer ?ware licen[sc]e", r"buy me a beer in return"]),
    ("artistic-{v}", ("1 0", "2 0"), ("artistic",), 10, 0.9, [r"artistic license (?:version )?{v}", r"spdx license identifier artistic {v}"]),
    ("artistic", ("",), ("artistic",), 30, 0.75, [r"artistic licen[sc]e"]),
    ("psf-2.0", ("",), ("python",), 20, 0.85, [r"python software foundation license(?: version)?(?: 2)?"]),
    ("psf-2.0", ("",), ("psf license",), 20, 0.85, [r"psf license agreement"]),
    ("php-{v}", ("3 0", "3 01"), ("php",), 10, 0.9, [r"php license (?:version |v)?{v}"]),
    ("ruby", ("",), ("ruby", "same terms"), 25, 0.75, [r"same terms as ruby"]),
    ("perl", ("",), ("perl", "same terms"), 25, 0.75, [r"same terms as perl(?: itself)?"]),
    ("openssl", ("",), ("openssl",), 20, 0.8, [r"openssl licen[sc]e", r"for use in the openssl toolkit"]),
    ("curl", ("",), ("curl", "licen"), 30, 0.7, [r"curl licen[sc]e"]),
    ("ncsa", ("",), ("ncsa",), 20, 0.85, [r"(?:university of illinois )?ncsa open source license"]),
    ("upl-1.0", ("",), ("universal permissive",), 20, 0.9, [r"universal permissive license(?: version| v)?(?: 1 0)?"]),
    ("ms-pl", ("",), ("microsoft public",), 20, 0.85, [r"microsoft public licen[sc]e"]),
    ("ms-rl", ("",), ("microsoft reciprocal",), 20, 0.85, [r"microsoft reciprocal licen[sc]e"]),
    ("osl-{v}", ("1 0", "1 1", "2 0", "2 1", "3 0"), ("open software license",), 10, 0.9, [r"open software license (?:version |v ?)?{v}"]),
    ("afl-{v}", ("1 1", "1 2", "2 0", "2 1", "3 0"), ("academic free",), 10, 0.9, [r"academic free license (?:version |v ?)?{v}"]),
    ("ofl-{v}", ("1 0", "1 1"), ("open font",), 10, 0.9, [r"(?:sil )?open font license (?:version |v)?{v}"]),
    ("ofl", ("",), ("open font",), 30, 0.8, [r"(?:sil )?open font licen[sc]e"]),
    ("odbl-1.0", ("",), ("open database",), 15, 0.85, [r"open database license(?: v| version)?(?: 1 0)?"]),
    ("odc-by-1.0", ("",), ("open data commons",), 15, 0.85, [r"open data commons attribution license"]),
    ("pddl-1.0", ("",), ("public domain dedication",), 25, 0.8, [r"open data commons public domain dedication"]),
    ("cc0-1.0", ("",), ("cc0",), 10, 0.9, [r"cc0(?: 1 0)?(?: universal)?"]),
    ("cc0-1.0", ("",), ("creativecommons org publicdomain",), 10, 0.9, [r"creativecommons org publicdomain zero 1 0"]),
    ("cc0-1.0", ("",), ("public domain dedication",), 20, 0.85, [r"creative commons (?:zero )?public domain dedication"]),
    ("cc-by-nc-nd-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0", "4"), ("cc by nc nd",), 4, 0.95, [r"cc by nc nd {v}"]),
    ("cc-by-nc-sa-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0", "4"), ("cc by nc sa",), 4, 0.95, [r"cc by nc sa {v}"]),
    ("cc-by-nc-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0", "4"), ("cc by nc",), 6, 0.95, [r"cc by nc {v}"]),
    ("cc-by-sa-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0", "4"), ("cc by sa",), 6, 0.95, [r"cc by sa {v}"]),
    ("cc-by-nd-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0", "4"), ("cc by nd",), 6, 0.95, [r"cc by nd {v}"]),
    ("cc-by-{v}", ("1 0", "2 0", "2 5", "3 0", "4 0", "4"), ("cc by",), 8, 0.95, [r"cc by {v}"]),
    ("cc-by-nc-nd", ("",), ("cc by nc nd",), 20, 0.9, [r"cc by nc nd"]),
    ("cc-by-nc-sa", ("",), ("cc by nc sa",), 20, 0.9, [r"cc by nc sa"]),
    ("cc-by-nc", ("",), ("cc by nc",), 30, 0.9, [r"cc by nc"]),
    ("cc-by-sa", ("",), ("cc by sa",), 30, 0.9, [r"cc by sa"]),
    ("cc-by-nd", ("",), ("cc by nd",), 30, 0.9, [r"cc by nd"]),
    ("cc-by", ("",), ("cc by",), 60, 0.8, [r"cc by"]),
    ("cc-{v}", ("by", "by nc", "by sa", "by nd", "by nc sa", "by nc nd"), ("creativecommons",), 10, 0.95, [r"creativecommons org licenses {v}(?: \d)*"]),
    ("cc-by-nc-nd", ("",), ("creative commons", "noncommercial"), 8, 0.9, [r"creative commons attribution noncommercial no ?deriv(?:ative)?s?"]),
    ("cc-by-nc-sa", ("",), ("creative commons", "noncommercial"), 8, 0.9, [r"creative commons attribution noncommercial share ?alike"]),
    ("cc-by-nc", ("",), ("creative commons", "noncommercial"), 12, 0.9, [r"creative commons attribution noncommercial"]),
    ("cc-by-nc", ("",), ("creative commons", "non commercial"), 12, 0.9, [r"creative commons attribution non commercial"]),
    ("cc-by-sa", ("",), ("creative commons",), 12, 0.9, [r"creative commons attribution share ?alike"]),
    ("cc-by-nd", ("",), ("creative commons",), 12, 0.9, [r"creative commons attribution no ?deriv(?:ative)?s?"]),
    ("cc-by", ("",), ("creative commons",), 30, 0.85, [r"creative commons attribution(?: \d)*"]),
    ("creative-commons", ("",), ("creative commons",), 70, 0.6, [r"creative commons(?: licen[sc]e)?"]),
    ("public-domain", ("",), ("public domain",), 60, 0.7, [r"(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain", r"public domain (?:software|work|mark)"]),
    ("copyleft", ("",), ("copyleft",), 70, 0.5, [r"copyleft"]),
    ("proprietary", ("",), ("proprietary",), 50, 0.6, [r"proprietary and confidential", r"confidential and proprietary"]),
    ("proprietary", ("",), ("unauthori",), 50, 0.6, [r"unauthori[sz]ed (?:copying|use|reproduction) [^\n]{0,80}? (?:is strictly )?prohibited"]),
    ("commercial", ("",), ("commercial",), 60, 0.5, [r"commercial licen[sc]e (?:agreement|terms)", r"for non commercial use only"]),
    ("commercial", ("",), ("noncommercial",), 60, 0.5, [r"for noncommercial use only"]),
    ("eula", ("",), ("license agreement",), 50, 0.6, [r"end user license agreement", r"software license agreement"]),
    ("trademark", ("",), ("trademark",), 70, 0.4, [r"registered trademarks? of", r"trademarks? of [^\n]{1,40}? (?:inc|corporation|ltd|gmbh)"]),
    ("warranty-disclaimer", ("",), ("warrant",), 65, 0.5, [r"without warrant(?:y|ies) of any kind", r"without warranties or conditions of any kind", r"provided as is without warrant"]),
    ("reserved", ("",), ("rights reserved",), 80, 0.6, [r"all rights reserved"]),
    ("some-rights-reserved", ("",), ("rights reserved",), 80, 0.6, [r"some rights reserved"]),
    ("no-rights-reserved", ("",), ("rights reserved",), 80, 0.6, [r"no rights reserved"]),
    ("copyright", ("",), ("copyright",), 90, 0.4, [r"copyright(?: c)? (?:19|20)\d\d(?: (?:19|20)\d\d)?", r"copyright c", r"copyright notice"]),
    ("apache-2.0", ("",), ("apache software foundation",), 20, 0.9, [r"licensed to the apache software foundation(?: asf)? under one or more contributor license agreements"]),
    ("apache-2.0", ("",), ("in compliance with the license",), 25, 0.85, [r"you may not use this file except in compliance with the license"]),
    ("apache-2.0", ("",), ("applicable law",), 25, 0.8, [r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"]),
    ("gpl", ("",), ("free software",), 45, 0.7, [r"this program is free software you can redistribute it and or modify", r"this program is free software it may be used copied modified"]),
    ("gpl", ("",), ("in the hope that",), 48, 0.7, [r"distributed in the hope that it will be useful but without any warranty"]),
    ("gpl", ("",), ("should have received",), 42, 0.8, [r"you should have received a copy of the gnu general public license"]),
    ("lgpl", ("",), ("should have received",), 22, 0.85, [r"you should have received a copy of the gnu (?:lesser|library) general public license"]),
    ("agpl", ("",), ("should have received",), 22, 0.85, [r"you should have received a copy of the gnu affero general public license"]),
    ("gfdl", ("",), ("modify this document",), 25, 0.85, [r"permission is granted to copy distribute and or modify this document"]),
    ("gnu-all-permissive", ("",), ("without royalty",), 25, 0.8, [r"in any medium without royalty provided the copyright notice and this notice are preserved"]),
    ("mpl-2.0", ("",), ("source code form",), 12, 0.95, [r"this source code form is subject to the terms of the mozilla public license"]),
    ("mpl-2.0", ("",), ("secondary licenses",), 20, 0.85, [r"incompatible with secondary licenses"]),
    ("epl", ("",), ("accompanying materials",), 35, 0.7, [r"this program and the accompanying materials are made available under the terms of the eclipse public license"]),
    ("mit-0", ("",), ("no attribution",), 8, 0.9, [r"mit no attribution(?: licen[sc]e)?"]),
    ("mit-0", ("",), ("spdx license identifier mit 0",), 8, 0.95, [r"spdx license identifier mit 0"]),
    ("0bsd", ("",), ("0bsd",), 10, 0.9, [r"0bsd(?: licen[sc]e)?"]),
    ("0bsd", ("",), ("zero clause bsd",), 10, 0.9, [r"(?:bsd )?zero clause bsd(?: licen[sc]e)?"]),
    ("json", ("",), ("not evil",), 15, 0.9, [r"the software shall be used for good not evil"]),
    ("qpl-1.0", ("",), ("q public",), 20, 0.85, [r"(?:the )?q public license(?: version)?(?: 1 0)?"]),
    ("sleepycat", ("",), ("sleepycat",), 20, 0.85, [r"sleepycat licen[sc]e"]),
    ("vim", ("",), ("vim",), 25, 0.75, [r"vim licen[sc]e"]),
    ("w3c", ("",), ("w3c",), 20, 0.85, [r"w3c software (?:notice and )?licen[sc]e", r"w3c software and document (?:notice and )?licen[sc]e"]),
    ("xfree86", ("",), ("xfree86",), 20, 0.8, [r"xfree86 licen[sc]e"]),
    ("zpl-{v}", ("1 1", "2 0", "2 1"), ("zope public",), 10, 0.9, [r"zope public license(?: zpl)? (?:version |v ?)?{v}"]),
    ("zpl", ("",), ("zope public",), 30, 0.8, [r"zope public licen[sc]e"]),
    ("unicode", ("",), ("unicode",), 20, 0.85, [r"unicode licen[sc]e (?:agreement|v3)", r"unicode inc license agreement data files and software"]),
    ("icu", ("",), ("icu licen",), 25, 0.8, [r"icu licen[sc]e"]),
    ("postgresql", ("",), ("postgresql",), 20, 0.8, [r"postgresql licen[sc]e"]),
    ("hpnd", ("",), ("historical permission",), 20, 0.85, [r"historical permission notice and disclaimer"]),
    ("lppl-{v}", ("1 0", "1 1", "1 2", "1 3a", "1 3c"), ("latex project public",), 10, 0.9, [r"latex project public license (?:version |v ?)?{v}"]),
    ("lppl", ("",), ("lppl",), 30, 0.8, [r"lppl(?: version| v)?(?: 1(?: \d[ac]?)?)?"]),
    ("lppl", ("",), ("latex project public",), 30, 0.8, [r"latex project public licen[sc]e"]),
    ("mulanpsl-{v}", ("1", "2"), ("mulan",), 10, 0.9, [r"mulan permissive software license(?: v| version )?{v}", r"mulan psl ?v?{v}"]),
    ("cecill-{v}", ("1 0", "1 1", "2 0", "2 1"), ("cecill",), 10, 0.9, [r"cecill (?:version |v ?)?{v}"]),
    ("cecill", ("",), ("cecill",), 30, 0.8, [r"cecill(?: [bc])? (?:free software )?licen[sc]e"]),
    ("nasa-1.3", ("",), ("nasa open source",), 20, 0.85, [r"nasa open source agreement(?: version)?(?: 1 3)?"]),
    ("rpl-{v}", ("1 1", "1 5"), ("reciprocal public",), 10, 0.9, [r"reciprocal public license (?:version |v ?)?{v}"]),
    ("sspl-1.0", ("",), ("server side public",), 15, 0.9, [r"server side public license(?: version| v)?(?: 1)?"]),
    ("sspl-1.0", ("",), ("sspl",), 20, 0.85, [r"sspl(?: v?1(?: 0)?)?"]),
    ("busl-1.1", ("",), ("business source",), 15, 0.9, [r"business source license(?: version)?(?: 1 1)?"]),
    ("elastic-2.0", ("",), ("elastic licen",), 15, 0.85, [r"elastic licen[sc]e(?: v?2(?: 0)?)?"]),
    ("commons-clause", ("",), ("commons clause",), 15, 0.9, [r"commons clause(?: licen[sc]e)? condition", r"commons clause"]),
    ("blueoak-1.0.0", ("",), ("blue oak",), 15, 0.9, [r"blue oak model licen[sc]e"]),
    ("polyform", ("",), ("polyform",), 15, 0.9, [r"polyform (?:noncommercial|shield|strict|small business|free trial|internal use) licen[sc]e"]),
    ("parity", ("",), ("parity public",), 20, 0.85, [r"(?:the )?parity public licen[sc]e"]),
    ("ogl-uk", ("",), ("open government",), 15, 0.9, [r"open government licen[sc]e(?: v ?[123](?: 0)?)?"]),
    ("lal", ("",), ("free art",), 20, 0.85, [r"free art licen[sc]e"]),
    ("cdla", ("",), ("community data",), 15, 0.9, [r"community data license agreement(?: (?:permissive|sharing))?"]),
    ("opl-1.0", ("",), ("open publication",), 20, 0.85, [r"open publication licen[sc]e"]),
    ("apsl-{v}", ("1 0", "1 1", "1 2", "2 0"), ("apple public source",), 10, 0.9, [r"apple public source license (?:version |v ?)?{v}"]),
    ("ipl-1.0", ("",), ("ibm public",), 20, 0.85, [r"ibm public license(?: version)?(?: 1 0)?"]),
    ("ecl-2.0", ("",), ("educational community",), 20, 0.85, [r"educational community license(?: version)?(?: 2 0)?"]),
    ("sissl", ("",), ("sun industry standards",), 20, 0.85, [r"sun industry standards source licen[sc]e"]),
    ("openrail", ("",), ("openrail",), 20, 0.85, [r"(?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[sc]e)?"]),
    ("rail", ("",), ("responsible ai",), 20, 0.85, [r"responsible ai licen[sc]e"]),
    ("cc0-1.0", ("",), ("creative commons zero",), 15, 0.9, [r"creative commons zero(?: 1 0)?(?: universal)?"]),
    ("creative-commons", ("",), ("licensed under a creative",), 65, 0.7, [r"licensed under a creative commons"]),
    ("trade-secret", ("",), ("trade secret",), 70, 0.4, [r"contains? (?:the )?(?:confidential and )?trade secrets?(?: of)?"]),
    ("spdx", ("",), ("spdx",), 95, 0.6, [r"spdx license identifier [a-z0-9]+(?: \d)*"]),
]

#: Labels and words of the base phrases (fixed values).
BASE = [("cc-by", ("cc", "by")), ("gpl", ("general", "public", "license")), ("reserved", ("all", "rights", "reserved"))]


def _label(label: str, version: str) -> str:
    """The family's label with a version: "2 0" is 2.0, "3" 3.0 and "by nc" by-nc."""
    if version.isdigit() and label.endswith(("-{v}", "-{v}-or-later")) and not label.startswith("mulan"):
        version += " 0"
    return label.replace("{v}", version.replace(" ", "-" if version.startswith("by") else "."))


def rules() -> list[Rule]:
    """Every pattern of every version of every family, strongest first; of equals those of the longer version first.

    A match begins and ends where words do: at spaces, or the text's ends."""
    out = []
    for label, versions, keywords, priority, confidence, patterns in FAMILIES:
        for v in sorted(versions, key=len, reverse=True):
            out += [Rule(_label(label, v), re.compile(rf"(?<![^ ])(?:{p.replace('{v}', v)})(?![^ ])"), tuple(k.replace("{v}", v) for k in keywords), priority, confidence) for p in patterns]
    return sorted(out, key=lambda r: r.priority)
