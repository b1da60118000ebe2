"""Signature rules of the license scan, in order of priority.

One rule a line: label, keyword phrase, weight in percent, pattern. Patterns are written over the
words of a text (lower case, one blank between words); ``phrase`` gives the form
in which they are matched. Every match of a pattern holds its keyword.
"""

# fixed values: label | keyword | weight | pattern
RULES_TEXT = """
apache-2.0 | apache license | 99 | licensed under the apache license version 2 0
apache-2.0 | apache license | 95 | (the )?apache license (version|v) ?2( 0)?
apache-2.0 | apache license | 90 | apache license 2 0
apache-2.0 | apache | 90 | spdx license identifier apache 2 0
apache-2.0 | apache | 85 | www apache org licenses license 2 0
apache-2.0 | apache | 80 | (under|with) (the )?apache 2( 0)? licen[cs]e
apache-2.0 | apache | 70 | apache 2 0
apache-1.1 | apache | 90 | apache (software )?license (version )?1 1
apache-1.1 | apache | 80 | spdx license identifier apache 1 1
apache-1.0 | apache | 90 | apache (software )?license (version )?1 0
apache | apache license | 50 | apache license
apache | apache software license | 60 | (the )?apache software license
apache | apache | 50 | apache style licen[cs]e
mit | mit license | 99 | released under the mit license
mit | mit license | 95 | (licensed|distributed|available|provided) under (the )?(terms of the )?mit license
mit | mit licence | 95 | (released|licensed|distributed) under (the )?mit licence
mit | mit license | 80 | (the )?mit license( mit)?
mit | mit licence | 80 | (the )?mit licence
mit | spdx | 90 | spdx license identifier mit
mit | free of charge | 95 | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | without restriction | 90 | deal in the software without restriction including without limitation the rights
mit | permission notice | 85 | the above copyright notice and this permission notice shall be included in all copies
mit | opensource | 80 | opensource org licenses mit
mit | expat | 80 | expat licen[cs]e
mit-0 | mit no attribution | 95 | mit no attribution( license)?
mit-0 | spdx | 95 | spdx license identifier mit 0
x11 | x11 license | 85 | (the )?x11 license
x11 | x consortium | 80 | (the )?name of the x consortium
gpl-3.0 | general public license | 99 | licensed under the gnu general public license version 3
gpl-3.0 | general public license | 98 | gnu general public license (as published by the free software foundation )?(either )?version 3
gpl-3.0 | general public license | 90 | general public license v ?3( 0)?
gpl-3.0 | general public license | 90 | general public license v3( 0)?
gpl-3.0 | gplv3 | 85 | gplv3
gpl-3.0 | gpl | 85 | (gnu )?gpl (version )?v?3( 0)?
gpl-3.0 | spdx | 95 | spdx license identifier gpl 3 0( only| or later)?
gpl-3.0-or-later | general public license | 99 | gnu general public license version 3 or (any )?later( version)?
gpl-3.0-or-later | spdx | 97 | spdx license identifier gpl 3 0 or later
gpl-2.0 | general public license | 98 | gnu general public license (as published by the free software foundation )?(either )?version 2
gpl-2.0 | general public license | 90 | general public license v2( 0)?
gpl-2.0 | gplv2 | 85 | gplv2
gpl-2.0 | gpl | 85 | (gnu )?gpl (version )?v?2( 0)?
gpl-2.0 | spdx | 95 | spdx license identifier gpl 2 0( only| or later)?
gpl-2.0-or-later | general public license | 99 | gnu general public license version 2 or (any )?later( version)?
gpl-2.0-or-later | spdx | 97 | spdx license identifier gpl 2 0 or later
gpl-1.0 | general public license | 90 | gnu general public license version 1
gpl | general public license | 75 | (the )?(gnu )?general public license
gpl | gpl | 55 | (under|with) (the )?(terms of the )?(gnu )?gpl
gpl | gpl | 50 | gnu gpl
gpl | free software foundation | 70 | redistribute it and or modify it under the terms of the gnu .{1,60} free software foundation
agpl-3.0 | affero general public license | 98 | gnu affero general public license (as published by the free software foundation )?(either )?version 3
agpl-3.0 | affero general public license | 90 | (gnu )?affero general public license v3( 0)?
agpl-3.0 | agplv3 | 85 | agplv3
agpl-3.0 | spdx | 95 | spdx license identifier agpl 3 0( only| or later)?
agpl | affero general public license | 80 | (the )?(gnu )?affero general public license
agpl | agpl | 55 | (gnu )?agpl
lgpl-3.0 | lesser general public license | 98 | gnu lesser general public license (as published by the free software foundation )?(either )?version 3
lgpl-3.0 | lgplv3 | 85 | lgplv3
lgpl-3.0 | spdx | 95 | spdx license identifier lgpl 3 0( only| or later)?
lgpl-2.1 | lesser general public license | 98 | gnu lesser general public license (as published by the free software foundation )?(either )?version 2 1
lgpl-2.1 | lgplv2 | 80 | lgplv2( 1)?
lgpl-2.1 | spdx | 95 | spdx license identifier lgpl 2 1( only| or later)?
lgpl-2.0 | library general public license | 95 | gnu library general public license( version 2)?
lgpl-2.0 | spdx | 95 | spdx license identifier lgpl 2 0( only| or later)?
lgpl | lesser general public license | 80 | (the )?(gnu )?lesser general public license
lgpl | lgpl | 55 | (gnu )?lgpl
gfdl-1.3 | free documentation license | 95 | gnu free documentation license version 1 3
gfdl-1.2 | free documentation license | 95 | gnu free documentation license version 1 2
gfdl | free documentation license | 80 | (the )?(gnu )?free documentation license
gfdl | gfdl | 60 | (gnu )?gfdl
cc-by-nc-nd-4.0 | cc by nc nd | 98 | (licensed under )?cc by nc nd 4 0
cc-by-nc-nd | cc by nc nd | 90 | cc by nc nd( [1-3] 0)?
cc-by-nc-nd | noncommercial noderivatives | 95 | creative commons attribution noncommercial noderivatives( [1-4] 0)?( international)?
cc-by-nc-nd | non commercial no derivatives | 95 | creative commons attribution non commercial no derivatives( [1-4] 0)?( international)?
cc-by-nc-sa-4.0 | cc by nc sa | 98 | (licensed under )?cc by nc sa 4 0
cc-by-nc-sa | cc by nc sa | 90 | cc by nc sa( [1-3] 0)?
cc-by-nc-sa | noncommercial sharealike | 95 | creative commons attribution noncommercial sharealike( [1-4] 0)?( international)?
cc-by-nc-sa | non commercial share alike | 95 | creative commons attribution non commercial share alike( [1-4] 0)?( international)?
cc-by-nc-4.0 | cc by nc | 98 | licensed under cc by nc 4 0
cc-by-nc-4.0 | cc by nc | 95 | cc by nc 4 0
cc-by-nc | cc by nc | 85 | cc by nc( [1-3] 0)?
cc-by-nc | noncommercial | 90 | creative commons attribution noncommercial( [1-4] 0)?( international)?
cc-by-nc | non commercial | 90 | creative commons attribution non commercial( [1-4] 0)?( international)?
cc-by-nd-4.0 | cc by nd | 95 | (licensed under )?cc by nd 4 0
cc-by-nd | cc by nd | 85 | cc by nd( [1-3] 0)?
cc-by-nd | noderivatives | 90 | creative commons attribution noderivatives( [1-4] 0)?( international)?
cc-by-nd | no derivatives | 90 | creative commons attribution no derivatives( [1-4] 0)?( international)?
cc-by-sa-4.0 | cc by sa | 98 | (licensed under )?cc by sa 4 0
cc-by-sa-3.0 | cc by sa | 95 | (licensed under )?cc by sa 3 0
cc-by-sa | cc by sa | 85 | cc by sa( [1-2] [05])?
cc-by-sa | sharealike | 90 | creative commons attribution sharealike( [1-4] 0)?( international| unported)?
cc-by-sa | share alike | 90 | creative commons attribution share alike( [1-4] 0)?( international| unported)?
cc-by-4.0 | cc by | 95 | (licensed under )?cc by 4 0
cc-by-3.0 | cc by | 95 | (licensed under )?cc by 3 0
cc-by-2.0 | cc by | 90 | (licensed under )?cc by 2 [05]
cc-by | creative commons attribution | 85 | creative commons attribution( license)?( [1-4] 0)?( international| unported)?
cc-by | creativecommons | 85 | creativecommons org licenses by [1-4] 0
cc-by-sa | creativecommons | 85 | creativecommons org licenses by sa [1-4] 0
cc-by-nc | creativecommons | 85 | creativecommons org licenses by nc [1-4] 0
cc-by-nd | creativecommons | 85 | creativecommons org licenses by nd [1-4] 0
cc-by-nc-sa | creativecommons | 85 | creativecommons org licenses by nc sa [1-4] 0
cc-by-nc-nd | creativecommons | 85 | creativecommons org licenses by nc nd [1-4] 0
cc0-1.0 | cc0 | 95 | cc0 1 0( universal)?
cc0-1.0 | cc0 | 80 | (under|with) (the )?(creative commons )?cc0
cc0-1.0 | creativecommons | 90 | creativecommons org publicdomain zero 1 0
cc0-1.0 | creative commons zero | 90 | creative commons zero( v ?1 0)?( universal)?
cc-pdm | creativecommons | 85 | creativecommons org publicdomain mark 1 0
cc-pdm | public domain mark | 85 | public domain mark( 1 0)?
cc | creative commons | 50 | (a |the )?creative commons licen[cs]e
public-domain | public domain | 85 | (released|placed|dedicated) (in|into|to) the public domain
public-domain | public domain | 75 | (this|the) (work|file|software|code|text) is (in )?(the )?public domain
public-domain | public domain | 60 | public domain dedication
bsd-3-clause | bsd 3 clause | 95 | (the )?bsd 3 clause( new or revised)?( license)?
bsd-3-clause | 3 clause bsd | 95 | (the )?3 clause bsd( license)?
bsd-3-clause | three clause bsd | 95 | three clause bsd( license)?
bsd-3-clause | new bsd | 85 | (the )?new bsd license
bsd-3-clause | modified bsd | 85 | (the )?modified bsd license
bsd-3-clause | endorse or promote | 85 | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-2-clause | bsd 2 clause | 95 | (the )?bsd 2 clause( simplified)?( license)?
bsd-2-clause | 2 clause bsd | 95 | (the )?2 clause bsd( license)?
bsd-2-clause | simplified bsd | 85 | (the )?simplified bsd license
bsd-2-clause | freebsd license | 85 | (the )?freebsd license
bsd-2-clause | binary forms | 80 | redistribution and use in source and binary forms with or without modification are permitted
bsd-4-clause | bsd 4 clause | 95 | bsd 4 clause( original or old)?( license)?
bsd-4-clause | advertising materials | 85 | all advertising materials mentioning features or use of this software must display
bsd-0-clause | 0bsd | 85 | (zero clause bsd )?0bsd
bsd-0-clause | zero clause bsd | 90 | (the )?zero clause bsd( license)?
bsd | bsd license | 60 | (a |the )?bsd license
bsd | bsd style | 55 | bsd style licen[cs]e
isc | isc license | 90 | (the )?isc license
isc | spdx | 95 | spdx license identifier isc
isc | with or without fee | 80 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
mpl-2.0 | mozilla public license | 98 | mozilla public license (version |v ?)?2 0
mpl-2.0 | mozilla | 90 | mozilla org mpl 2 0
mpl-2.0 | spdx | 95 | spdx license identifier mpl 2 0
mpl-1.1 | mozilla public license | 95 | mozilla public license (version )?1 1
mpl-1.1 | spdx | 95 | spdx license identifier mpl 1 1
mpl | mozilla public license | 75 | (the )?mozilla public license
epl-2.0 | eclipse public license | 95 | eclipse public license (version |v ?)?2 0
epl-1.0 | eclipse public license | 95 | eclipse public license (version |v ?)?1 0
epl | eclipse public license | 75 | (the )?eclipse public license
epl-2.0 | spdx | 95 | spdx license identifier epl 2 0
edl-1.0 | eclipse distribution license | 90 | eclipse distribution license( v ?1 0| version 1 0)?
cddl-1.0 | development and distribution license | 90 | common development and distribution license( version)?( 1 0)?
cddl-1.1 | development and distribution license | 95 | common development and distribution license (version )?1 1
cddl | cddl | 60 | (the )?cddl
cpl-1.0 | common public license | 85 | common public license( version)?( 1 0)?
ipl-1.0 | ibm public license | 85 | ibm public license( version)?( 1 0)?
eupl-1.2 | eupl | 90 | eupl (version |v ?)?1 2
eupl-1.1 | eupl | 90 | eupl (version |v ?)?1 1
eupl | european union public licence | 85 | european union public licence( v ?1 [12])?
osl-3.0 | open software license | 90 | open software license( version)?( v)?( 3 0)?
afl-3.0 | academic free license | 90 | academic free license( version)?( v)?( 3 0)?
artistic-2.0 | artistic license | 95 | (the )?artistic license (version )?2 0
artistic-1.0 | artistic license | 90 | (the )?artistic license (version )?1 0
artistic | artistic license | 70 | (the )?(perl )?artistic license
artistic | same terms as perl | 80 | under the same terms as perl( itself)?
zlib | zlib license | 90 | (the )?zlib license
zlib | zlib libpng | 85 | zlib libpng license
zlib | altered source versions | 85 | altered source versions must be plainly marked as such
libpng | libpng license | 80 | (the )?libpng license
bsl-1.0 | boost software license | 95 | boost software license( version)?( 1 0)?
bsl-1.0 | spdx | 95 | spdx license identifier bsl 1 0
busl-1.1 | business source license | 95 | business source license( version)?( 1 1)?
sspl-1.0 | server side public license | 95 | server side public license( version)?( 1)?
elastic-2.0 | elastic license | 85 | elastic license( 2 0| v2)?
unlicense | unlicense | 85 | (released under )?the unlicense
unlicense | unlicense | 85 | unlicense org
unlicense | unencumbered | 95 | this is free and unencumbered software released into the public domain
wtfpl | do what the fuck | 95 | do what the fuck you want to public license
wtfpl | wtfpl | 80 | (the )?wtfpl
beerware | beer ware license | 90 | (the )?beer ware license
beerware | beerware | 75 | beerware( license)?
psf-2.0 | python software foundation license | 90 | python software foundation license( version)?( 2)?
psf-2.0 | psf license | 75 | (the )?psf license
python-2.0 | spdx | 90 | spdx license identifier python 2 0
php-3.01 | php license | 90 | (the )?php license( version)?( 3 01| 3 0)?
ruby | ruby license | 80 | (the )?ruby license
ruby | same terms as ruby | 80 | under the same terms as ruby
vim | vim license | 80 | (the )?vim license
tcl | tcl tk license | 80 | (the )?tcl tk license
openssl | openssl license | 90 | (the )?openssl license
openssl | openssl toolkit | 80 | for use in the openssl toolkit
curl | curl license | 80 | (the )?curl license
icu | icu license | 80 | (the )?icu license
ncsa | illinois ncsa | 90 | university of illinois ncsa open source license
ncsa | ncsa open source | 80 | (the )?ncsa open source license
postgresql | postgresql license | 90 | (the )?postgresql license
sleepycat | sleepycat license | 85 | (the )?sleepycat license
qpl-1.0 | q public license | 85 | (the )?q public license( version)?( 1 0)?
ofl-1.1 | open font license | 95 | (the )?(sil )?open font license( version)?( 1 1)?
ofl-1.1 | ofl | 70 | sil ofl( 1 1)?
odbl-1.0 | open database license | 95 | (the )?(odc )?open database license( v ?1 0)?
odbl-1.0 | odbl | 75 | (the )?odbl
odc-by-1.0 | open data commons attribution | 95 | open data commons attribution license( v ?1 0)?
odc-by-1.0 | odc by | 75 | odc by( 1 0)?
pddl-1.0 | public domain dedication and licen | 90 | (open data commons )?public domain dedication and licen[cs]e
cdla-permissive | community data license | 90 | community data license agreement permissive( 1 0| 2 0)?
cdla-sharing | community data license | 90 | community data license agreement sharing( 1 0)?
ogl-3.0 | open government licence | 90 | (the )?open government licence( v3 0| v ?3)?
ogl-canada | open government licence canada | 95 | open government licence canada( 2 0)?
etalab-2.0 | licence ouverte | 90 | licence ouverte( open licence)?( 2 0| v2 0)?
dl-de-by-2.0 | datenlizenz deutschland | 90 | datenlizenz deutschland (namensnennung|zero)( 2 0| version 2 0)?
ms-pl | microsoft public license | 90 | (the )?microsoft public license
ms-rl | microsoft reciprocal license | 90 | (the )?microsoft reciprocal license
ms-eula | microsoft software license | 80 | microsoft software license terms
apple | apple public source license | 90 | apple public source license( version)?( 2 0)?
nasa | nasa open source agreement | 90 | nasa open source agreement( version)?( 1 3)?
upl-1.0 | universal permissive license | 90 | (the )?universal permissive license( v ?1 0| version 1 0)?
cecill-2.1 | cecill | 85 | (the )?cecill( free software)? licen[cs]e( agreement)?( v ?2 1)?
cecill-b | cecill b | 85 | (the )?cecill b licen[cs]e
mulan-2.0 | mulan | 85 | mulan (psl|permissive software license)( v2| 2 0)?
json | good not evil | 90 | the software shall be used for good not evil
gust-font | gust font license | 85 | (the )?gust font license
ubuntu-font | ubuntu font licence | 85 | (the )?ubuntu font licence( 1 0)?
lppl-1.3c | latex project public license | 90 | (the )?latex project public license( version)?( 1 3 ?c?)?
openrail | openrail | 85 | (creativeml |bigscience )?openrail( m| ) ?(license)?
rail | responsible ai license | 85 | (a |the )?responsible ai license
llama | llama | 80 | llama [2-4]( [0-9])? community license( agreement)?
gemma | gemma terms of use | 80 | gemma terms of use
gsfdl | free art license | 85 | (the )?free art license( 1 3)?
lal-1.3 | licence art libre | 85 | (la )?licence art libre( 1 3)?
wikipedia | wikimedia | 60 | text is available under the creative commons .{1,60} wikimedia
project-gutenberg | project gutenberg license | 85 | (the )?(full )?project gutenberg license
proprietary | proprietary and confidential | 85 | (this .{1,40} is )?proprietary and confidential
proprietary | confidential and proprietary | 85 | confidential and proprietary( information)?
proprietary | end user license agreement | 75 | (this )?end user license agreement
proprietary | prior written permission | 70 | may not be (reproduced|copied|distributed) .{0,60}without (the )?(express )?prior written permission
proprietary | no part of this | 75 | no part of this (publication|work|book|document) may be (reproduced|copied|stored|transmitted)
proprietary | trade secret | 60 | (trade secret|trade secret information)
proprietary | unauthorized copying | 80 | unauthorized copying( of this (file|software|work))?( via any medium)?( is)? (strictly )?prohibited
proprietary | unpublished | 60 | unpublished (work|copyright|proprietary source code)
noncommercial | non commercial use only | 80 | (for )?non commercial use only
noncommercial | noncommercial use only | 80 | (for )?noncommercial use only
noncommercial | personal use only | 70 | (for )?personal use only
noncommercial | research purposes only | 75 | (for )?research purposes only
noncommercial | academic use only | 75 | (for )?academic use only
noncommercial | polyform noncommercial | 95 | polyform noncommercial license( 1 0 0)?
reserved | all rights reserved | 85 | (copyright .{1,60} )?all rights reserved
reserved | alle rechte vorbehalten | 85 | alle rechte vorbehalten
reserved | tous droits réservés | 85 | tous droits réservés
reserved | todos los derechos reservados | 85 | todos los derechos reservados
reserved | some rights reserved | 60 | some rights reserved
reserved | no rights reserved | 60 | no rights reserved
copyright | copyright c | 50 | copyright c [0-9][0-9][0-9][0-9]
copyright | copyright | 50 | copyright [0-9][0-9][0-9][0-9]
copyright | spdx | 70 | spdx filecopyrighttext
"""

# fixed values: phrases that always count, and their labels
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]


def phrase(words: str) -> str:
    """A phrase or pattern as it is matched: each word has a blank on either side."""
    return " " + words.replace(" ", "  ") + " "


def rules() -> list[tuple[int, str, str, float, str]]:
    """(priority, label, keyword, weight, pattern), first rule first."""
    out = []
    for k, line in enumerate(x for x in RULES_TEXT.splitlines() if x):
        label, keyword, weight, pattern = (x.strip() for x in line.split(" | "))
        # a gap may not swallow the blank that a word needs
        out.append((k, label, phrase(keyword), int(weight) / 100, " (?:" + pattern.replace(" ", "  ") + ") "))
    return out
