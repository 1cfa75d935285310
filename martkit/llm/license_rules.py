"""Signature rules of the license scan.

A rule is a regular expression over a text's words (lower case, one space
between words, punctuation gone), gated by a keyword that is in everything the
pattern matches; alternatives without a common keyword are rules of their own.  Rules come from three hand-written lists: license names, which a
few phrasings turn into title, notice and identifier rules each; clauses that
tell a license by its wording; and clues.  Priority 3 is a notice or clause
(decisive), 2 a name, 1 a clue; a rule is suppressed where a rule of the
same or a higher priority covers its place.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, keyword of the gate, name as words, SPDX identifier as words
# (none where an earlier entry has it).
NAMES = [
    ("gpl-1.0", "gnu", "gnu (?:general public license|gpl) (?:version |v)1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    ("gpl-2.0", "gnu", "gnu (?:general public license|gpl) (?:version |v)2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3.0", "gnu", "gnu (?:general public license|gpl) (?:version |v)3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.0", "gnu", "gnu (?:library|lesser) general public license (?:version |v)2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", "gnu", "gnu lesser general public license (?:version |v)2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", "gnu", "gnu lesser general public license (?:version |v)3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", "gnu", "gnu affero general public license(?: (?:version |v)3(?: 0)?)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "gnu", "gnu free documentation license(?: version 1 [123])?", "gfdl 1 [123](?: only| or later)?"),
    ("apache-1.0", "apache", "apache (?:software )?license version 1 0", "apache 1 0"),
    ("apache-1.1", "apache", "apache (?:software )?license version 1 1", "apache 1 1"),
    ("apache-2.0", "apache", "apache (?:software )?license (?:version |v)?2 0", "apache 2 0"),
    ("mit", "mit", "(?:the )?mit (?:license|licence)", "mit"),
    ("mit-0", "mit", "mit no attribution(?: license)?", "mit 0"),
    ("x11", "x11", "(?:the )?x11 license", "x11"),
    ("bsd-0-clause", "bsd", "(?:zero|0) clause bsd(?: license)?", "0bsd"),
    ("bsd-1-clause", "bsd", "(?:one|1) clause bsd(?: license)?", "bsd 1 clause"),
    ("bsd-2-clause", "bsd", "(?:(?:two|2) clause|simplified|freebsd) bsd(?: license)?", "bsd 2 clause(?: patent)?"),
    ("bsd-3-clause", "bsd", "(?:(?:three|3) clause|new|revised|modified) bsd(?: license)?", "bsd 3 clause(?: clear)?"),
    ("bsd-4-clause", "bsd", "(?:(?:four|4) clause|original|old) bsd(?: license)?", "bsd 4 clause"),
    ("bsd", "bsd", "bsd (?:style )?(?:license|licence)", "bsd"),
    ("isc", "isc", "(?:the )?isc (?:license|licence)", "isc"),
    ("mpl-1.0", "mozilla", "mozilla public license (?:version |v)?1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", "mozilla public license (?:version |v)?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", "mozilla public license (?:version |v)?2 0", "mpl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public license (?:version |v)?1 0", "epl 1 0"),
    ("epl-2.0", "eclipse", "eclipse public license (?:version |v)?2 0", "epl 2 0"),
    ("edl-1.0", "eclipse", "eclipse distribution license(?: (?:version |v)?1 0)?", "edl 1 0"),
    ("cddl-1.0", "development", "common development and distribution license(?: cddl)?(?: version 1 [01])?", "cddl 1 [01]"),
    ("cddl-1.0", "cddl", "cddl(?: (?:version |v)?1 [01])?", None),
    ("cpl-1.0", "common", "common public license(?: version 1 0)?", "cpl 1 0"),
    ("cpal-1.0", "common", "common public attribution license(?: version 1 0)?", "cpal 1 0"),
    ("eupl", "european", "european union public licen[cs]e(?: (?:version |v)?1 [012])?", "eupl 1 [012]"),
    ("artistic-1.0", "artistic", "(?:the )?artistic license(?: (?:version )?1 0)?", "artistic 1 0(?: perl)?"),
    ("artistic-2.0", "artistic", "(?:the )?artistic license (?:version )?2 0", "artistic 2 0"),
    ("boost-1.0", "boost", "boost software license(?: version 1 0)?", "bsl 1 0"),
    ("zlib", "zlib", "(?:the )?zlib(?: libpng)? license", "zlib"),
    ("libpng", "libpng", "(?:the )?libpng license(?: version 2)?", "libpng(?: 2 0)?"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("curl", "curl", "(?:the )?curl license", "curl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license", "ncsa"),
    ("postgresql", "postgresql", "(?:the )?postgresql license", "postgresql"),
    ("python-2.0", "license", "(?:python software foundation|psf) license(?: version 2)?", "(?:psf|python) 2 0"),
    ("php-3.01", "php", "(?:the )?php license(?: version 3 01)?", "php 3 0?1"),
    ("ruby", "ruby", "(?:the )?ruby license", "ruby"),
    ("ms-pl", "microsoft", "microsoft public license(?: ms pl)?", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license(?: ms rl)?", "ms rl"),
    ("osl-3.0", "open software", "open software license(?: (?:version |v)?[123] [01])?", "osl [123] [01]"),
    ("afl-3.0", "academic", "academic free license(?: (?:version |v)?[123] [01])?", "afl [123] [01]"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "fuck", "do what the fuck you want to public license", "wtfpl"),
    ("wtfpl", "wtfpl", "wtfpl", None),
    ("beerware", "beer", "(?:the )?beer ?ware license", "beerware"),
    ("ofl-1.1", "sil", "sil open font license(?: (?:version |v)?1 [01])?", "ofl 1 [01]"),
    ("odbl-1.0", "open d", "open (?:data commons open )?database license(?: odbl)?(?: (?:version |v)?1 0)?", "odbl 1 0"),
    ("odc-by-1.0", "open d", "open data commons attribution license(?: (?:version |v)?1 0)?", "odc by 1 0"),
    ("pddl-1.0", "public domain", "(?:open data commons )?public domain dedication and license", "pddl 1 0"),
    ("cc0-1.0", "cc0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "cc by", "cc by(?: [1234] [05])?", "cc by [1234] [05]"),
    ("cc-by-sa", "cc by", "cc by sa(?: [1234] [05])?", "cc by sa [1234] [05]"),
    ("cc-by-nc", "cc by", "cc by nc(?: [1234] [05])?", "cc by nc [1234] [05]"),
    ("cc-by-nd", "cc by", "cc by nd(?: [1234] [05])?", "cc by nd [1234] [05]"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa(?: [1234] [05])?", "cc by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd(?: [1234] [05])?", "cc by nc nd [1234] [05]"),
    ("cc-by", "creative", "creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?(?: license)?", "cc by"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported)?(?: license)?", "cc by sa"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported)?(?: license)?", "cc by nc"),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s?(?: [1234] [05])?(?: international)?(?: license)?", "cc by nd"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international)?(?: license)?", "cc by nc sa"),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1234] [05])?(?: license)?", "cc by nc nd"),
    ("bsl-1.1", "business", "business source license(?: (?:version )?1 1)?", "busl 1 1"),
    ("sspl-1.0", "server side", "server side public license(?: (?:version |v)?1)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", "elastic license(?: 2 0)?", "elastic 2 0"),
    ("openrail-m", "rail", "(?:creativeml |bigscience )?open ?rail(?: m)?(?: license)?", "openrail(?: m)?"),
    ("llama", "llama", "llama (?:2|3|3 1|3 2|4)? ?community license(?: agreement)?", "llama[234]"),
]

# Label, keyword, wording.
CLAUSES = [
    ("gpl", "redistribute", "this (?:program|library|file) is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("gpl-2.0-or-later", "gnu", "gnu general public license(?: as published by the free software foundation)? either version 2(?: 0)?(?: of the license)? or (?:at your option )?any later version"),
    ("gpl-3.0-or-later", "gnu", "gnu general public license(?: as published by the free software foundation)? either version 3(?: 0)?(?: of the license)? or (?:at your option )?any later version"),
    ("lgpl", "gnu", "gnu lesser general public license as published by the free software foundation"),
    ("agpl-3.0", "gnu", "gnu affero general public license as published by the free software foundation"),
    ("gpl-exception", "exception", "as a special exception (?:to the gnu general public license|you may)"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 the license"),
    ("apache-2.0", "apache", "you may obtain a copy of the license at (?:http|https) www apache org licenses license 2 0"),
    ("apache-2.0", "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "permission", "the above copyright notice and this permission notice shall be included in all copies or substantial portions"),
    ("mit-or-x11", "liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("bsd", "redistribut", "redistributions? of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "redistribut", "redistributions? in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "endorse", "neither the names? of (?:the )?.{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ments?"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("ntp", "permission", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("zlib", "warrant", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("boost-1.0", "permission", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-2.0", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cddl-1.0", "development", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("cc0-1.0", "waive", "to the extent possible under law .{1,80}? has waived all copyright and related or neighboring rights"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("beerware", "beer", "you can buy me a beer in return"),
    ("ofl-1.1", "font", "this font software is licensed under the sil open font license"),
    ("python-2.0", "psf hereby", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("postgresql", "california", "in no event shall the university of california be liable to any party"),
    ("proprietary", "confidential", "(?:this (?:software|document) is )?(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", "unauthorized", "unauthorized (?:copying|reproduction|distribution|use) (?:of this (?:file|document|work) )?(?:is )?(?:strictly )?prohibited"),
    ("non-commercial", "use only", "(?:for|free for) (?:non commercial|noncommercial|personal|academic|research) use only"),
]

# Label, keyword, words that hint at a license.
CLUES = [
    ("unknown-spdx", "spdx", "spdx license identifier [a-z0-9]+"),
    ("unknown-license", "under", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?[a-z0-9]+(?: [a-z0-9]+){0,4}? (?:license|licence)"),
    ("license-file", "see ", "see (?:the )?(?:accompanying )?(?:license|licence|copying)(?: file| txt| md)"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)?[0-9]{2})?"),
    ("copyright", "reserved", "all rights reserved"),
    ("gpl", "gpl", "gpl(?: ?v?[123](?: 0)?)?"),
    ("lgpl", "lgpl", "lgpl(?: ?v?[23](?: [01])?)?"),
    ("agpl", "agpl", "agpl(?: ?v?3(?: 0)?)?"),
    ("creative-commons", "creativecommons", "creativecommons org licenses [a-z]+(?: [a-z]+){0,2} [1234] [05]"),
    ("apache-2.0", "apache", "apache org licenses license 2 0"),
    ("mit", "opensource", "opensource org licenses mit(?: license)?(?: php)?"),
    ("bsd", "opensource", "opensource org licenses bsd(?: license| [234] clause)?"),
    ("gpl", "gnu", "(?:www )?gnu org licenses a?l?gpl(?: [23] [01])?"),
    ("unlicense", "unlicense", "unlicense org"),
]

_NOTICE = "(?:licensed|licenced|released|distributed|available|published|provided|governed|covered) (?:under|by) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"


def rules() -> list[Rule]:
    """All rules in order: base phrases are apart (see ``BASE``)."""
    out = []
    for label, keyword, name, spdx in NAMES:
        out.append(Rule(label, 2, keyword, f"(?:{name})"))
        out.append(Rule(label, 3, keyword, f"{_NOTICE}(?:{name})"))
        if spdx:
            out.append(Rule(label, 3, "spdx", f"spdx license identifier {spdx}"))
    out += [Rule(label, 3, keyword, wording) for label, keyword, wording in CLAUSES]
    out += [Rule(label, 1, keyword, words) for label, keyword, words in CLUES]
    return out
