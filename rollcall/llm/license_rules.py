"""Signature rules of the license scan, written one by one; fixed values: label, priority, score, keyword, regular expression.

Expressions run over lower-cased words joined by single spaces (punctuation is gone: "2.0" is "2 0"). A match
holds the keyword, and at most ``license_scan.REACH`` words. Priority: 9 identifiers, 8 texts of grants, 7 names
with version, 6 grants by name, 5 names, 3 notices of rights, 1 fragments.
"""

# Words of which every rule's match holds one.
GATES = ["licen", "copyright", "public", "warrant", "permission", "redistribut", "rights", "spdx", "liable"]

# The rules, in order; of two equal places the earlier rule stays.
RULES = [
    ("mit", 9, 1.0, "spdx", "spdx license identifier mit"),
    ("mit-0", 9, 1.0, "spdx", "spdx license identifier mit 0"),
    ("apache-2.0", 9, 1.0, "spdx", "spdx license identifier apache 2 0"),
    ("apache-1.1", 9, 1.0, "spdx", "spdx license identifier apache 1 1"),
    ("gpl-2.0", 9, 1.0, "spdx", "spdx license identifier gpl 2 0(?: only)?"),
    ("gpl-2.0+", 9, 1.0, "spdx", "spdx license identifier gpl 2 0 or later"),
    ("gpl-3.0", 9, 1.0, "spdx", "spdx license identifier gpl 3 0(?: only)?"),
    ("gpl-3.0+", 9, 1.0, "spdx", "spdx license identifier gpl 3 0 or later"),
    ("lgpl-2.1", 9, 1.0, "spdx", "spdx license identifier lgpl 2 1(?: only| or later)?"),
    ("lgpl-3.0", 9, 1.0, "spdx", "spdx license identifier lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", 9, 1.0, "spdx", "spdx license identifier agpl 3 0(?: only| or later)?"),
    ("bsd-2-clause", 9, 1.0, "spdx", "spdx license identifier bsd 2 clause"),
    ("bsd-3-clause", 9, 1.0, "spdx", "spdx license identifier bsd 3 clause"),
    ("bsd-4-clause", 9, 1.0, "spdx", "spdx license identifier bsd 4 clause"),
    ("0bsd", 9, 1.0, "spdx", "spdx license identifier 0bsd"),
    ("isc", 9, 1.0, "spdx", "spdx license identifier isc"),
    ("mpl-2.0", 9, 1.0, "spdx", "spdx license identifier mpl 2 0"),
    ("epl-2.0", 9, 1.0, "spdx", "spdx license identifier epl 2 0"),
    ("unlicense", 9, 1.0, "spdx", "spdx license identifier unlicense"),
    ("cc0-1.0", 9, 1.0, "spdx", "spdx license identifier cc0 1 0"),
    ("cc-by-4.0", 9, 1.0, "spdx", "spdx license identifier cc by 4 0"),
    ("cc-by-sa-4.0", 9, 1.0, "spdx", "spdx license identifier cc by sa 4 0"),
    ("bsl-1.0", 9, 1.0, "spdx", "spdx license identifier bsl 1 0"),
    ("zlib", 9, 1.0, "spdx", "spdx license identifier zlib"),
    # texts of grants
    ("mit", 8, 1.0, "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 8, 0.9, "merge publish distribute", "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense"),
    ("mit", 8, 0.9, "shall be included", "the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", 8, 0.8, "in no event shall the authors", "in no event shall the authors or copyright holders be liable for any claim"),
    ("isc", 8, 1.0, "use copy modify and", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", 8, 0.9, "disclaims all warranties", "the author disclaims all warranties with regard to this software"),
    ("bsd", 8, 0.9, "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", 8, 0.8, "retain the above", "redistributions of source code must retain the above copyright notice"),
    ("bsd", 8, 0.8, "in binary form", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", 8, 0.9, "endorse or promote", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", 8, 0.9, "advertising materials", "all advertising materials mentioning features or use of this software .{0,80}?rights"),
    ("gpl", 8, 0.9, "is free software", "this (?:program|library|file|package) is free software you can redistribute it and or modify it"),
    ("gpl", 8, 0.8, "received a copy", "you should have received a copy of the gnu general public license along with this (?:program|library|file|package)"),
    ("lgpl", 8, 0.8, "received a copy", "you should have received a copy of the gnu lesser general public license along with this (?:program|library|file|package)"),
    ("agpl", 8, 0.8, "received a copy", "you should have received a copy of the gnu affero general public license along with this (?:program|library|file|package)"),
    ("gpl", 8, 0.7, "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-2.0", 8, 0.9, "either version 2", "general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-3.0", 8, 0.9, "either version 3", "general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2.0", 8, 0.9, "foundation version 2", "general public license as published by the free software foundation version 2"),
    ("gpl-3.0", 8, 0.9, "foundation version 3", "general public license as published by the free software foundation version 3"),
    ("apache-2.0", 8, 1.0, "except in compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0", 8, 0.9, "governing permissions", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", 8, 0.9, "as is basis", "distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("apache-2.0", 8, 0.8, "apache org", "http(?:s)? www apache org licenses license 2 0"),
    ("mpl-2.0", 8, 1.0, "source code form", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl-2.0", 8, 0.9, "secondary licenses", "incompatible with secondary licenses as defined by the mozilla public license"),
    ("unlicense", 8, 1.0, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 8, 1.0, "do what the", "do what the [^ ]+ you want to public license"),
    ("zlib", 8, 0.9, "altered source", "altered source versions must be plainly marked as such .{0,80}?warrant[^ ]*"),
    ("zlib", 8, 0.9, "anyone to use", "permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("bsl-1.0", 8, 0.9, "obtaining a copy of the software and accompanying", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying"),
    ("cc0-1.0", 8, 0.9, "waived all copyright", "has waived all copyright and related or neighboring rights"),
    ("cc-by", 8, 0.8, "share and adapt", "you are free to share and adapt .{0,60}?licen[cs]e"),
    ("postgresql", 8, 0.9, "documentation for any purpose", "permission to use copy modify and distribute this software and its documentation for any purpose without fee"),
    ("ofl-1.1", 8, 0.9, "font software", "this font software is licensed under the sil open font license"),
    ("w3c", 8, 0.9, "w3c", "permission to copy modify and distribute this .{0,40}?w3c"),
    ("python-2.0", 8, 0.9, "psf", "psf license agreement for python"),
    ("openssl", 8, 0.9, "openssl toolkit", "software developed by the openssl project for use in the openssl toolkit .{0,60}?licen[cs]e"),
    # names with version
    ("apache-2.0", 7, 1.0, "apache", "(?:licensed under )?(?:the )?apache(?: software)? license(?: version| v)? ?2(?: 0)?"),
    ("apache-1.1", 7, 1.0, "apache", "apache(?: software)? license(?: version| v)? ?1 1"),
    ("apache-1.0", 7, 1.0, "apache", "apache(?: software)? license(?: version| v)? ?1 0"),
    ("apache-2.0", 7, 0.8, "apache 2", "apache 2(?: 0)? licen[cs]e[ds]?"),
    ("gpl-1.0", 7, 1.0, "general public", "(?:gnu )?general public license(?: version| v)? ?1(?: 0)?"),
    ("gpl-2.0", 7, 1.0, "general public", "(?:gnu )?general public license(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", 7, 1.0, "general public", "(?:gnu )?general public license(?: version| v)? ?3(?: 0)?"),
    ("gpl-2.0", 7, 0.9, "version 2 of the gnu", "version 2(?: 0)? of the gnu general public license"),
    ("gpl-3.0", 7, 0.9, "version 3 of the gnu", "version 3(?: 0)? of the gnu general public license"),
    ("gpl-2.0", 7, 0.8, "gpl", "(?:gnu )?gpl(?: version)? ?v?2(?: 0)? licen[cs]e[ds]?"),
    ("gpl-3.0", 7, 0.8, "gpl", "(?:gnu )?gpl(?: version)? ?v?3(?: 0)? licen[cs]e[ds]?"),
    ("gpl-2.0", 7, 0.8, "gpl", "licensed under (?:the )?(?:gnu )?gpl(?: version)? ?v?2(?: 0)?"),
    ("gpl-3.0", 7, 0.8, "gpl", "licensed under (?:the )?(?:gnu )?gpl(?: version)? ?v?3(?: 0)?"),
    ("lgpl-2.0", 7, 1.0, "library general", "(?:gnu )?library general public license(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", 7, 1.0, "lesser general", "(?:gnu )?lesser general public license(?: version| v)? ?2 1"),
    ("lgpl-3.0", 7, 1.0, "lesser general", "(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2.1", 7, 0.8, "lgpl", "licensed under (?:the )?(?:gnu )?lgpl(?: version)? ?v?2 1"),
    ("lgpl-3.0", 7, 0.8, "lgpl", "licensed under (?:the )?(?:gnu )?lgpl(?: version)? ?v?3(?: 0)?"),
    ("agpl-3.0", 7, 1.0, "affero", "(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?"),
    ("agpl-3.0", 7, 0.8, "agpl", "licensed under (?:the )?(?:gnu )?agpl(?: version)? ?v?3(?: 0)?"),
    ("fdl-1.2", 7, 1.0, "free documentation", "(?:gnu )?free documentation license(?: version| v)? ?1 2"),
    ("fdl-1.3", 7, 1.0, "free documentation", "(?:gnu )?free documentation license(?: version| v)? ?1 3"),
    ("mpl-1.0", 7, 1.0, "mozilla", "mozilla public license(?: version| v)? ?1 0"),
    ("mpl-1.1", 7, 1.0, "mozilla", "mozilla public license(?: version| v)? ?1 1"),
    ("mpl-2.0", 7, 1.0, "mozilla", "mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl-2.0", 7, 0.8, "mpl", "licensed under (?:the )?mpl(?: version)? ?v?2(?: 0)?"),
    ("epl-1.0", 7, 1.0, "eclipse", "eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", 7, 1.0, "eclipse", "eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("edl-1.0", 7, 1.0, "eclipse", "eclipse distribution license(?: version| v)? ?1(?: 0)?"),
    ("bsd-1-clause", 7, 1.0, "bsd", "bsd 1 clause licen[cs]e"),
    ("bsd-2-clause", 7, 1.0, "bsd", "bsd 2 clause licen[cs]e"),
    ("bsd-3-clause", 7, 1.0, "bsd", "bsd 3 clause licen[cs]e"),
    ("bsd-4-clause", 7, 1.0, "bsd", "bsd 4 clause licen[cs]e"),
    ("bsd-2-clause", 7, 1.0, "clause bsd", "(?:2|two) clause bsd(?: style)? licen[cs]e"),
    ("bsd-3-clause", 7, 1.0, "clause bsd", "(?:3|three) clause bsd(?: style)? licen[cs]e"),
    ("bsd-4-clause", 7, 1.0, "clause bsd", "(?:4|four) clause bsd(?: style)? licen[cs]e"),
    ("bsd-2-clause", 7, 0.9, "simplified bsd", "simplified bsd licen[cs]e"),
    ("bsd-2-clause", 7, 0.9, "freebsd", "freebsd(?: documentation)? licen[cs]e"),
    ("bsd-3-clause", 7, 0.9, "new bsd", "new bsd licen[cs]e"),
    ("bsd-3-clause", 7, 0.9, "modified bsd", "modified bsd licen[cs]e"),
    ("bsd-3-clause", 7, 0.9, "revised bsd", "revised bsd licen[cs]e"),
    ("bsd-4-clause", 7, 0.9, "original bsd", "original bsd licen[cs]e"),
    ("bsd-3-clause-clear", 7, 1.0, "clear bsd", "clear bsd licen[cs]e"),
    ("0bsd", 7, 1.0, "zero clause", "(?:bsd )?zero clause(?: bsd)? licen[cs]e"),
    ("artistic-1.0", 7, 1.0, "artistic", "artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", 7, 1.0, "artistic", "artistic license(?: version| v)? ?2(?: 0)?"),
    ("afl-2.1", 7, 1.0, "academic free", "academic free license(?: version| v)? ?2 1"),
    ("afl-3.0", 7, 1.0, "academic free", "academic free license(?: version| v)? ?3(?: 0)?"),
    ("osl-2.1", 7, 1.0, "open software", "open software license(?: version| v)? ?2 1"),
    ("osl-3.0", 7, 1.0, "open software", "open software license(?: version| v)? ?3(?: 0)?"),
    ("cddl-1.0", 7, 1.0, "common development", "common development and distribution license(?: version| v)? ?1 0"),
    ("cddl-1.1", 7, 1.0, "common development", "common development and distribution license(?: version| v)? ?1 1"),
    ("cpl-1.0", 7, 1.0, "common public", "common public license(?: version| v)? ?1(?: 0)?"),
    ("cpal-1.0", 7, 1.0, "common public attribution", "common public attribution license(?: version| v)? ?1(?: 0)?"),
    ("eupl-1.1", 7, 1.0, "european union", "european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", 7, 1.0, "european union", "european union public licen[cs]e(?: version| v)? ?1 2"),
    ("ecl-2.0", 7, 1.0, "educational community", "educational community license(?: version| v)? ?2(?: 0)?"),
    ("ofl-1.0", 7, 1.0, "open font", "(?:sil )?open font license(?: version| v)? ?1 0"),
    ("ofl-1.1", 7, 1.0, "open font", "(?:sil )?open font license(?: version| v)? ?1 1"),
    ("odbl-1.0", 7, 1.0, "open database", "open database license(?: version| v)? ?1(?: 0)?"),
    ("odc-by-1.0", 7, 1.0, "open data commons", "open data commons attribution license(?: version| v)?(?: 1 0)?"),
    ("pddl-1.0", 7, 1.0, "public domain dedication", "(?:open data commons )?public domain dedication and license(?: 1 0)?"),
    ("bsl-1.0", 7, 1.0, "boost", "boost software license(?: version| v)? ?1(?: 0)?"),
    ("busl-1.1", 7, 1.0, "business source", "business source license(?: version| v)? ?1 1"),
    ("sspl-1.0", 7, 1.0, "server side", "server side public license(?: version| v)?(?: 1)?"),
    ("elastic-2.0", 7, 1.0, "elastic", "elastic license(?: version| v)? ?2(?: 0)?"),
    ("cecill-2.1", 7, 1.0, "cecill", "cecill(?: free software)? license(?: agreement)?(?: version| v)? ?2 1"),
    ("psf-2.0", 7, 1.0, "python software", "python software foundation license(?: version| v)? ?2"),
    ("php-3.01", 7, 1.0, "php license", "php license(?: version| v)? ?3 01"),
    ("zpl-2.1", 7, 1.0, "zope", "zope public license(?: version| v)? ?2 1"),
    ("lppl-1.3c", 7, 1.0, "latex", "latex project public license(?: version| v)?(?: 1 3c?)?"),
    ("upl-1.0", 7, 1.0, "universal permissive", "universal permissive license(?: version| v)?(?: 1 0)?"),
    ("blueoak-1.0.0", 7, 1.0, "blue oak", "blue oak model license(?: 1 0 0)?"),
    ("mulan-psl-2.0", 7, 1.0, "mulan", "mulan permissive software license(?: version| v)?(?: ?2)?"),
    ("ncsa", 7, 1.0, "ncsa", "(?:university of illinois )?ncsa open source license"),
    ("llama-2", 7, 1.0, "llama 2", "llama 2 community license(?: agreement)?"),
    ("llama-3", 7, 1.0, "llama 3", "llama 3(?: [0-9])? community license(?: agreement)?"),
    # creative commons
    ("cc-by-4.0", 7, 1.0, "attribution", "(?:creative commons )?attribution 4 0(?: international)?(?: public)? license"),
    ("cc-by-3.0", 7, 1.0, "attribution", "(?:creative commons )?attribution 3 0(?: unported)? license"),
    ("cc-by-2.0", 7, 1.0, "attribution", "(?:creative commons )?attribution 2 0(?: generic)? license"),
    ("cc-by-sa-4.0", 7, 1.0, "sharealike", "(?:creative commons )?attribution sharealike 4 0(?: international)?(?: public)? license"),
    ("cc-by-sa-3.0", 7, 1.0, "sharealike", "(?:creative commons )?attribution sharealike 3 0(?: unported)? license"),
    ("cc-by-nc-4.0", 7, 1.0, "noncommercial", "(?:creative commons )?attribution noncommercial 4 0(?: international)?(?: public)? license"),
    ("cc-by-nc-3.0", 7, 1.0, "noncommercial", "(?:creative commons )?attribution noncommercial 3 0(?: unported)? license"),
    ("cc-by-nd-4.0", 7, 1.0, "noderiv", "(?:creative commons )?attribution noderiv(?:ative)?s 4 0(?: international)?(?: public)? license"),
    ("cc-by-nc-sa-4.0", 7, 1.0, "noncommercial sharealike", "(?:creative commons )?attribution noncommercial sharealike 4 0(?: international)?(?: public)? license"),
    ("cc-by-nc-nd-4.0", 7, 1.0, "noncommercial noderiv", "(?:creative commons )?attribution noncommercial noderiv(?:ative)?s 4 0(?: international)?(?: public)? license"),
    ("cc-by-4.0", 7, 0.9, "cc by 4", "licensed under (?:a |the )?cc by 4 0"),
    ("cc-by-sa-4.0", 7, 0.9, "cc by sa", "licensed under (?:a |the )?cc by sa 4 0"),
    ("cc-by-nc-4.0", 7, 0.9, "cc by nc", "licensed under (?:a |the )?cc by nc 4 0"),
    ("cc0-1.0", 7, 0.9, "cc0", "cc0(?: 1 0)?(?: universal)?(?: public domain dedication| license)"),
    ("cc-by-4.0", 8, 0.9, "creativecommons org licenses by 4", "creativecommons org licenses by 4 0"),
    ("cc-by-sa-4.0", 8, 0.9, "creativecommons org licenses by sa", "creativecommons org licenses by sa 4 0"),
    ("cc-by-nc-4.0", 8, 0.9, "creativecommons org licenses by nc", "creativecommons org licenses by nc 4 0"),
    ("cc0-1.0", 8, 0.9, "creativecommons org publicdomain", "creativecommons org publicdomain zero 1 0"),
    # grants by name
    ("mit", 6, 0.9, "mit", "licensed under (?:the )?(?:terms of the )?mit(?: licen[cs]e)?"),
    ("mit", 6, 0.9, "mit", "(?:released|distributed|available|published|provided) under (?:the )?(?:terms of the )?mit licen[cs]e"),
    ("mit", 6, 0.8, "expat", "(?:licensed|released|distributed) under (?:the )?expat licen[cs]e"),
    ("x11", 6, 0.8, "x11", "(?:licensed|released|distributed) under (?:the )?x11 licen[cs]e"),
    ("apache", 6, 0.9, "apache", "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?apache(?: software)? license"),
    ("gpl", 6, 0.9, "gnu general", "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?gnu general public license"),
    ("gpl", 6, 0.8, "gpl", "licensed under (?:the )?(?:terms of the )?(?:gnu )?gpl"),
    ("lgpl", 6, 0.9, "lesser general", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?gnu lesser general public license"),
    ("lgpl", 6, 0.8, "lgpl", "licensed under (?:the )?(?:terms of the )?(?:gnu )?lgpl"),
    ("agpl", 6, 0.9, "affero", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?gnu affero general public license"),
    ("agpl", 6, 0.8, "agpl", "licensed under (?:the )?(?:terms of the )?(?:gnu )?agpl"),
    ("bsd", 6, 0.9, "bsd", "(?:licensed|released|distributed|available|published|provided) under (?:the |a )?(?:terms of the )?bsd(?: style)? licen[cs]e"),
    ("isc", 6, 0.9, "isc", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?isc licen[cs]e"),
    ("mpl", 6, 0.9, "mozilla", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mozilla public license"),
    ("epl", 6, 0.9, "eclipse", "(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?eclipse public license"),
    ("cc", 6, 0.8, "creative commons", "licensed under (?:a |the )?creative commons"),
    ("unlicense", 6, 0.9, "unlicense", "(?:licensed|released|distributed|available) under (?:the )?unlicense"),
    ("wtfpl", 6, 0.8, "wtfpl", "(?:licensed|released|distributed) under (?:the )?wtfpl licen[cs]e"),
    ("zlib", 6, 0.9, "zlib", "(?:licensed|released|distributed|available) under (?:the )?zlib(?: libpng)? licen[cs]e"),
    ("postgresql", 6, 0.9, "postgresql", "(?:licensed|released|distributed) under (?:the )?postgresql licen[cs]e"),
    ("openrail", 6, 0.8, "openrail", "(?:licensed|released|distributed) under (?:the )?(?:creativeml )?openrail(?: m)?(?: licen[cs]e)"),
    ("dual", 6, 0.6, "dual", "dual licen[cs]ed under"),
    ("same-as-perl", 6, 0.8, "perl itself", "under the same (?:license )?terms as perl itself .{0,40}?licen[cs]e"),
    # names
    ("mit", 5, 0.6, "mit", "mit licen[cs]e"),
    ("mit", 5, 0.6, "expat", "expat licen[cs]e"),
    ("x11", 5, 0.6, "x11", "x11 licen[cs]e"),
    ("apache", 5, 0.6, "apache", "apache(?: software)? license"),
    ("gpl", 5, 0.6, "general public", "(?:gnu )?general public license"),
    ("gpl", 5, 0.5, "gpl", "(?:gnu )?gpl licen[cs]e[ds]?"),
    ("lgpl", 5, 0.6, "lesser general", "(?:gnu )?lesser general public license"),
    ("lgpl", 5, 0.6, "library general", "(?:gnu )?library general public license"),
    ("agpl", 5, 0.6, "affero", "(?:gnu )?affero general public license"),
    ("bsd", 5, 0.6, "bsd", "bsd(?: style)? licen[cs]e"),
    ("isc", 5, 0.6, "isc", "isc licen[cs]e"),
    ("mpl", 5, 0.6, "mozilla", "mozilla public license"),
    ("epl", 5, 0.6, "eclipse", "eclipse public license"),
    ("artistic", 5, 0.6, "artistic", "artistic license"),
    ("cc", 5, 0.5, "creative commons", "creative commons(?: [^ ]+){0,3} license"),
    ("cddl", 5, 0.6, "common development", "common development and distribution license"),
    ("ofl", 5, 0.6, "open font", "(?:sil )?open font license"),
    ("odbl", 5, 0.6, "open database", "open database license"),
    ("busl", 5, 0.6, "business source", "business source license"),
    ("ms-pl", 5, 0.6, "microsoft public", "microsoft public license"),
    ("ms-rl", 5, 0.6, "microsoft reciprocal", "microsoft reciprocal license"),
    ("zlib", 5, 0.6, "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("postgresql", 5, 0.6, "postgresql", "postgresql licen[cs]e"),
    ("psf", 5, 0.6, "python", "python(?: software foundation)? license"),
    ("openssl", 5, 0.6, "openssl", "openssl license"),
    ("ruby", 5, 0.6, "ruby", "ruby license"),
    ("beerware", 5, 0.6, "beer", "beer ?ware license"),
    ("json", 5, 0.6, "json", "json license"),
    ("unlicense", 5, 0.6, "unlicense", "the unlicense"),
    ("public-domain", 5, 0.8, "public domain", "(?:dedicated to|released into|placed in|in) the public domain"),
    # notices of rights
    ("proprietary", 3, 0.7, "rights reserved", "all rights reserved"),
    ("proprietary", 3, 0.7, "rights reserved", "some rights reserved"),
    ("proprietary", 3, 0.7, "without", "may not be (?:copied|reproduced|distributed|used) without (?:the )?(?:prior )?(?:express )?(?:written )?permission"),
    ("proprietary", 3, 0.7, "no part of this", "no part of this [^ ]+ may be (?:copied|reproduced|distributed|transmitted) .{0,60}?permission"),
    ("proprietary", 3, 0.7, "confidential", "confidential and proprietary .{0,40}?rights"),
    ("proprietary", 3, 0.6, "end user", "end user license agreement"),
    ("proprietary", 3, 0.6, "terms of use", "subject to (?:the )?terms of use .{0,40}?licen[cs]e"),
    ("noncommercial", 3, 0.6, "non commercial", "for (?:personal and )?non commercial use only .{0,40}?(?:licen[cs]e|permission|rights)"),
    ("notice", 1, 0.4, "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("notice", 1, 0.3, "copyright", "copyrighted (?:work|material)"),
    ("notice", 1, 0.3, "warrant", "without warrant(?:y|ies) of any kind"),
    ("notice", 1, 0.3, "warrant", "(?:no|any) (?:express or )?implied warrant(?:y|ies)"),
    ("notice", 1, 0.3, "see the", "see (?:the )?licen[cs]e(?: file| txt)? for (?:more )?details"),
    ("notice", 1, 0.3, "all copies", "included? in all copies .{0,30}?(?:licen[cs]e|permission|rights)"),
    ("notice", 1, 0.2, "license agreement", "license agreement"),
]
