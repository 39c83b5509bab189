"""Signature rules of the license scan, hand-written over normalised text.

A rule is (level, label, keyword, pattern).  Patterns see lower-case words separated by single
blanks ("Version 2.0" reads "version 2 0") and match whole words.  ``keyword`` is a plain string
that every match contains; rules whose keyword a text lacks are not tried on it.  Levels order the
rules: 0 an SPDX tag, 1 a license with its version or variant, 2 a license by name, 3 a general
statement of licensing.
"""

from __future__ import annotations

import re

CONFIDENCE = (1.0, 0.95, 0.8, 0.5)

# identifiers as written in SPDX tags
SPDX = (
    "0BSD", "AAL", "AFL-1.1", "AFL-1.2", "AFL-2.0", "AFL-2.1", "AFL-3.0", "AGPL-1.0-only", "AGPL-1.0-or-later", "AGPL-3.0",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-1.0", "Apache-1.1", "Apache-2.0", "APSL-1.0", "APSL-2.0", "Artistic-1.0",
    "Artistic-2.0", "Beerware", "BlueOak-1.0.0", "BSD-1-Clause", "BSD-2-Clause", "BSD-2-Clause-Patent", "BSD-3-Clause",
    "BSD-3-Clause-Clear", "BSD-4-Clause", "BSL-1.0", "BUSL-1.1", "CAL-1.0", "CC-BY-1.0", "CC-BY-2.0", "CC-BY-2.5", "CC-BY-3.0",
    "CC-BY-4.0", "CC-BY-NC-1.0", "CC-BY-NC-2.0", "CC-BY-NC-2.5", "CC-BY-NC-3.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-3.0",
    "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-3.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-3.0", "CC-BY-ND-4.0", "CC-BY-SA-2.0", "CC-BY-SA-2.5",
    "CC-BY-SA-3.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "CDDL-1.1", "CECILL-2.1", "CECILL-B", "CECILL-C", "CPAL-1.0",
    "CPL-1.0", "ECL-2.0", "EFL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "FSFAP", "FTL", "GFDL-1.1", "GFDL-1.2",
    "GFDL-1.3", "GPL-1.0-only", "GPL-1.0-or-later", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only",
    "GPL-3.0-or-later", "HPND", "ICU", "IJG", "IPL-1.0", "ISC", "LGPL-2.0-only", "LGPL-2.0-or-later", "LGPL-2.1",
    "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LPL-1.02", "LPPL-1.3c", "MIT",
    "MIT-0", "MPL-1.0", "MPL-1.1", "MPL-2.0", "MS-PL", "MS-RL", "MulanPSL-2.0", "NCSA", "NPL-1.1", "ODbL-1.0", "OFL-1.0",
    "OFL-1.1", "OpenSSL", "OSL-1.0", "OSL-2.1", "OSL-3.0", "PDDL-1.0", "PHP-3.01", "PostgreSQL", "PSF-2.0", "Python-2.0", "QPL-1.0",
    "RPL-1.5", "Ruby", "SGI-B-2.0", "Sleepycat", "SSPL-1.0", "Unlicense", "UPL-1.0", "Vim", "W3C", "WTFPL", "X11", "Xnet",
    "Zlib", "ZPL-2.0", "ZPL-2.1",
)

_V = r"(?:version |ver |v )?v?"
_L = r"licen[sc]e"

# (level, label, keyword, pattern)
NAMED = (
    (1, "apache-1.0", "apache", rf"apache (?:software )?{_L} {_V}1 0"),
    (1, "apache-1.1", "apache", rf"apache (?:software )?{_L} {_V}1 1"),
    (1, "apache-2.0", "apache", rf"apache (?:software )?{_L} {_V}2(?: 0)?"),
    (1, "apache-2.0", "apache", r"apache v?2 0"),
    (1, "apache-2.0", "apache", r"www apache org licenses license 2 0"),
    (2, "apache", "apache", rf"(?:under the |under an? )?apache(?: software)? {_L}"),
    (2, "apache", "apache", r"apache style licen[sc]ed?"),
    (1, "mit-0", "mit", rf"mit (?:no attribution|0) {_L}"),
    (1, "mit-0", "mit", rf"mit {_L} no attribution"),
    (1, "mit", "mit", rf"(?:released|licensed|distributed|available|provided) under (?:the |an? )?(?:terms of the )?mit {_L}"),
    (2, "mit", "mit", rf"(?:the )?(?:expat )?mit(?: x11| expat)? {_L}"),
    (2, "mit", "mit", r"licensed under (?:the )?mit"),
    (1, "mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    (1, "x11", "x11", rf"x11 {_L}"),
    (1, "x11", "x consortium", r"name of the x consortium shall not be used"),
    (1, "isc", "isc", rf"isc {_L}"),
    (1, "isc", "permission", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    (1, "0bsd", "bsd", rf"(?:zero clause|0 clause|0) bsd(?: {_L})?"),
    (1, "0bsd", "bsd", r"bsd (?:zero|0) clause"),
    (1, "bsd-1-clause", "bsd", r"(?:bsd (?:1|one) clause|(?:1|one) clause bsd)"),
    (1, "bsd-2-clause", "bsd", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd)"),
    (1, "bsd-2-clause", "bsd", rf"(?:simplified|freebsd) bsd {_L}"),
    (1, "bsd-2-clause-patent", "bsd", r"bsd (?:2|two) clause (?:plus )?patent"),
    (1, "bsd-3-clause", "bsd", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd)"),
    (1, "bsd-3-clause", "bsd", rf"(?:new|modified|revised) bsd {_L}"),
    (1, "bsd-3-clause-clear", "bsd", rf"clear bsd {_L}"),
    (1, "bsd-4-clause", "bsd", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd)"),
    (1, "bsd-4-clause", "bsd", rf"(?:original|old) bsd {_L}"),
    (2, "bsd", "bsd", rf"bsd(?: style)? {_L}"),
    (2, "bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    (1, "bsd-3-clause", "neither the name", r"neither the name of .{1,80}? nor the names of (?:its|their) contributors"),
    (1, "bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software"),
    (1, "gpl-1.0", "general public", rf"gnu general public {_L} {_V}1(?: 0)?"),
    (1, "gpl-2.0", "general public", rf"(?:gnu )?general public {_L} {_V}2(?: 0)?"),
    (1, "gpl-3.0", "general public", rf"(?:gnu )?general public {_L} {_V}3(?: 0)?"),
    (1, "gpl-2.0-or-later", "general public", rf"general public {_L} .{{0,80}}?(?:either )?version 2 .{{0,60}}?any later version"),
    (1, "gpl-3.0-or-later", "general public", rf"general public {_L} .{{0,80}}?(?:either )?version 3 .{{0,60}}?any later version"),
    (1, "gpl-2.0", "gpl", r"(?:gnu )?gplv?2(?: 0)?"),
    (1, "gpl-2.0", "gpl", r"(?:gnu )?gpl (?:version |v )?v?2(?: 0)?"),
    (1, "gpl-3.0", "gpl", r"(?:gnu )?gplv?3(?: 0)?"),
    (1, "gpl-3.0", "gpl", r"(?:gnu )?gpl (?:version |v )?v?3(?: 0)?"),
    (2, "gpl", "gpl", rf"(?:gnu )?gpl(?: {_L})?"),
    (2, "gpl", "general public", rf"(?:gnu )?general public {_L}"),
    (1, "lgpl-2.0", "general public", rf"(?:gnu )?library general public {_L}(?: {_V}2(?: 0)?)?"),
    (1, "lgpl-2.1", "general public", rf"(?:gnu )?lesser general public {_L} {_V}2 1"),
    (1, "lgpl-3.0", "general public", rf"(?:gnu )?lesser general public {_L} {_V}3(?: 0)?"),
    (2, "lgpl", "general public", rf"(?:gnu )?lesser general public {_L}"),
    (1, "lgpl-2.1", "lgpl", r"lgpl(?: v|v| version )? ?2 1"),
    (1, "lgpl-3.0", "lgpl", r"lgpl(?: v|v| version )? ?3(?: 0)?"),
    (2, "lgpl", "lgpl", r"(?:gnu )?lgpl"),
    (1, "agpl-1.0", "affero", rf"(?:gnu )?affero general public {_L} {_V}1(?: 0)?"),
    (1, "agpl-3.0", "affero", rf"(?:gnu )?affero general public {_L} {_V}3(?: 0)?"),
    (2, "agpl", "affero", rf"(?:gnu )?affero general public {_L}"),
    (1, "agpl-3.0", "agpl", r"agpl(?: v|v| version )? ?3(?: 0)?"),
    (2, "agpl", "agpl", r"(?:gnu )?agpl"),
    (1, "gfdl-1.1", "documentation", rf"(?:gnu )?free documentation {_L} {_V}1 1"),
    (1, "gfdl-1.2", "documentation", rf"(?:gnu )?free documentation {_L} {_V}1 2"),
    (1, "gfdl-1.3", "documentation", rf"(?:gnu )?free documentation {_L} {_V}1 3"),
    (2, "gfdl", "documentation", rf"(?:gnu )?free documentation {_L}"),
    (2, "gfdl", "gfdl", r"gfdl"),
    (1, "mpl-1.0", "mozilla", rf"mozilla public {_L} {_V}1 0"),
    (1, "mpl-1.1", "mozilla", rf"mozilla public {_L} {_V}1 1"),
    (1, "mpl-2.0", "mozilla", rf"mozilla public {_L} {_V}2(?: 0)?"),
    (2, "mpl", "mozilla", rf"mozilla public {_L}"),
    (1, "mpl-1.1", "mpl", r"mpl (?:version |v )?v?1 1"),
    (1, "mpl-2.0", "mpl", r"mpl (?:version |v )?v?2(?: 0)?"),
    (1, "epl-1.0", "eclipse", rf"eclipse public {_L} {_V}1(?: 0)?"),
    (1, "epl-2.0", "eclipse", rf"eclipse public {_L} {_V}2(?: 0)?"),
    (2, "epl", "eclipse", rf"eclipse public {_L}"),
    (2, "bsd-3-clause", "eclipse", rf"eclipse distribution {_L}"),
    (1, "cpl-1.0", "common public", rf"common public {_L}(?: {_V}1(?: 0)?)?"),
    (1, "cddl-1.0", "common development", rf"common development and distribution {_L} {_V}1(?: 0)?"),
    (1, "cddl-1.1", "common development", rf"common development and distribution {_L} {_V}1 1"),
    (2, "cddl", "common development", rf"common development and distribution {_L}"),
    (1, "eupl-1.1", "european union", rf"european union public licen[sc]e {_V}1 1"),
    (1, "eupl-1.2", "european union", rf"european union public licen[sc]e {_V}1 2"),
    (2, "eupl", "european union", r"european union public licen[sc]e"),
    (1, "cecill-2.1", "cecill", r"cecill (?:free software licen[sc]e agreement )?(?:version |v )?v?2 1"),
    (1, "cecill-b", "cecill", r"cecill b"),
    (1, "cecill-c", "cecill", r"cecill c"),
    (2, "cecill", "cecill", r"cecill(?: licen[sc]e)?"),
    (1, "artistic-1.0", "artistic", rf"artistic {_L} {_V}1(?: 0)?"),
    (1, "artistic-2.0", "artistic", rf"artistic {_L} {_V}2(?: 0)?"),
    (2, "artistic", "artistic", rf"artistic {_L}"),
    (1, "bsl-1.0", "boost", rf"boost software {_L}(?: {_V}1(?: 0)?)?"),
    (1, "busl-1.1", "business source", rf"business source {_L}(?: {_V}1 1)?"),
    (1, "sspl-1.0", "server side", rf"server side public {_L}(?: {_V}1(?: 0)?)?"),
    (1, "elastic-2.0", "elastic", rf"elastic {_L}(?: {_V}2(?: 0)?)?"),
    (1, "zlib", "zlib", rf"zlib(?: libpng)? {_L}"),
    (1, "libpng", "libpng", rf"libpng {_L}"),
    (1, "unlicense", "unlicense", r"(?:the )?unlicense"),
    (1, "unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    (1, "wtfpl", "wtfpl", r"wtfpl"),
    (1, "wtfpl", "what the", rf"do what the f\w+ you want to public {_L}"),
    (1, "beerware", "beer", rf"beer ?ware(?: {_L})?"),
    (1, "ofl-1.1", "open font", rf"(?:sil )?open font {_L}(?: {_V}1 1)?"),
    (1, "odbl-1.0", "open database", rf"open database {_L}(?: {_V}1(?: 0)?)?"),
    (1, "odc-by-1.0", "open data commons", rf"open data commons attribution {_L}"),
    (1, "pddl-1.0", "public domain dedication", rf"public domain dedication and {_L}"),
    (1, "psf-2.0", "python", rf"python software foundation {_L}(?: {_V}2)?"),
    (1, "psf-2.0", "psf", rf"psf {_L}(?: {_V}2)?"),
    (1, "php-3.01", "php", rf"php {_L}(?: {_V}3 01)?"),
    (1, "ruby", "ruby", rf"ruby(?: s)? {_L}"),
    (1, "postgresql", "postgresql", rf"postgresql {_L}"),
    (1, "openssl", "openssl", rf"openssl {_L}"),
    (1, "ncsa", "illinois", rf"university of illinois (?:ncsa )?open source {_L}"),
    (1, "ms-pl", "microsoft public", rf"microsoft public {_L}"),
    (1, "ms-rl", "microsoft reciprocal", rf"microsoft reciprocal {_L}"),
    (1, "afl-3.0", "academic free", rf"academic free {_L}(?: {_V}3(?: 0)?)?"),
    (1, "osl-3.0", "open software", rf"open software {_L}(?: {_V}3(?: 0)?)?"),
    (1, "ecl-2.0", "educational community", rf"educational community {_L}(?: {_V}2(?: 0)?)?"),
    (1, "lppl-1.3c", "latex project", rf"latex project public {_L}(?: {_V}1 3c?)?"),
    (1, "qpl-1.0", "q public", rf"q public {_L}"),
    (1, "upl-1.0", "universal permissive", rf"universal permissive {_L}(?: {_V}1(?: 0)?)?"),
    (1, "mulanpsl-2.0", "mulan", rf"mulan permissive software {_L}(?: {_V}2)?"),
    (1, "vim", "vim", rf"vim {_L}"),
    (1, "w3c", "w3c", rf"w3c (?:software )?(?:notice and )?{_L}"),
    (1, "zpl-2.1", "zope", rf"zope public {_L}(?: {_V}2 1)?"),
    (1, "sleepycat", "sleepycat", rf"sleepycat {_L}"),
    (1, "ftl", "freetype", rf"freetype (?:project )?{_L}"),
    (1, "cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    (1, "cc0-1.0", "creative commons", r"creative commons zero"),
    (2, "cc", "creative commons", rf"creative commons(?: {_L})?"),
    (2, "public-domain", "public domain", r"(?:released |placed |dedicated |in )?(?:in )?(?:to |into )?the public domain"),
    (3, "proprietary", "rights reserved", r"all rights reserved"),
    (3, "proprietary", "rights are reserved", r"all rights are reserved"),
    (3, "proprietary", "proprietary", r"proprietary and confidential"),
    (3, "proprietary", "commercial", rf"commercial {_L} (?:agreement|required)"),
    (3, "copyleft-statement", "share", r"share alike"),
    (3, "license-statement", "licensed under", r"licensed under (?:the )?(?:terms of )?"r"(?:the )?\w+"),
    (3, "license-statement", "released under", r"released under (?:the )?(?:terms of )?(?:the )?\w+"),
    (3, "license-statement", "distributed under", r"distributed under (?:the )?(?:terms of )?(?:the )?\w+"),
    (3, "license-statement", "see the licen", r"see the licen[sc]e (?:file )?for (?:more |the |further )?(?:details|specific language)"),
    (3, "warranty-disclaimer", "without warranty", r"without warranty of any kind"),
    (3, "warranty-disclaimer", "provided", r"provided (?:by .{1,60}? )?as is"),
)

# Creative Commons variants: (code, words of the long name)
CC_VARIANTS = (
    ("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by nc", "attribution non ?commercial"), ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# strings of which a normalised text must hold one to be scanned by rule (the base phrases all hold "licen")
GATES = ("licen", "copyright", "gpl", "gfdl", "public domain", "spdx", "creative commons", " cc by", "cc0", "rights reserved", "rights are reserved", "wtfpl",
         "cecill", "redistribution and use", "without warranty", "permission is hereby", "permission to use", "proprietary and", "provided as", "provided by",
         "beerware", "beer ware", "bsd", "apache", " mpl", "advertising materials", "neither the name",
         "x consortium", "distributed under", "released under", "share alike", "unencumbered")


def _words(identifier: str) -> str:
    return " ".join(re.findall(r"[0-9a-z]+", identifier.lower()))


def all_rules() -> list[tuple[int, str, str, str]]:
    """Every rule in order; of two equal detections the earlier rule stays."""
    rules = [(0, name.lower(), "spdx license identifier", rf"spdx license identifier {_words(name)}")
             for name in sorted(SPDX, key=lambda n: -len(_words(n)))]
    for code, name in CC_VARIANTS:
        label = "cc-" + code.replace(" ", "-")
        for version in CC_VERSIONS:
            rules.append((1, f"{label}-{version}", f"cc {code}", rf"cc {code} {_words(version)}"))
            rules.append((1, f"{label}-{version}", "creative commons", rf"creative commons {name}(?: international| unported| generic)?(?: {_L})? {_V}{_words(version)}"))
        rules.append((2, label, f"cc {code}", rf"cc {code}"))
        rules.append((2, label, "creative commons", rf"creative commons {name}"))
    return rules + list(NAMED)
