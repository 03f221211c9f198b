"""License scan by ordered signature rules.

A text is reduced to words: A-Z lower-cased, words are runs of [0-9a-z] and non-ASCII characters. Hundreds of regex
rules run over the words joined by single spaces. A rule runs only if its keyword occurs (prefilter). Detections are
word intervals; they are taken by priority, then length, then place, and one that lies inside an interval already
taken is suppressed. Base phrases are counted at all their places and their labels are never suppressed.

Null and empty texts have no words: counts 0, first_word and last_word null, labels "", score 0. Each row gives a row,
repeated rows too; an empty table gives none; extra columns are ignored. Texts are scanned whole, in time that grows with
their length and the number of detections.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The phrases and labels of the base scan.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Words stay, other ASCII becomes a space.
_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))

#: label | names as regexes over joined words | keyword that every match holds
NAMES = r"""
mit | mit | mit
mit-0 | mit no attribution|mit 0 | mit
x11 | x11|mit x11 | x11
apache-1.1 | apache(?: software)?(?: license)?(?: version)? 1 1 | apache
apache-2 | apache(?: software)?(?: license)?(?: version)? 2(?: 0)? | apache
bsd-2-clause | bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd | bsd
bsd-3-clause | bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd | bsd
bsd-4-clause | bsd 4 clause|4 clause bsd|original bsd | bsd
0bsd | 0bsd|zero clause bsd|bsd zero clause | bsd
isc | isc | isc
zlib | zlib(?: libpng)? | zlib
libpng | libpng | libpng
boost-1 | boost software(?: license)?(?: version)?(?: 1 0)?|bsl 1 0 | b
unlicense | the unlicense|unlicense | unlicense
wtfpl | wtfpl|do what the fuck you want to public license | w
gpl-1 | gnu general public license(?: version)? 1(?: 0)?|gpl v?1(?: 0)? | g
gpl-2 | gnu general public license(?: as published by the free software foundation)?(?: version| v)? ?2(?: 0)?|gpl v? ?2(?: 0)? | g
gpl-3 | gnu general public license(?: as published by the free software foundation)?(?: version| v)? ?3(?: 0)?|gpl v? ?3(?: 0)? | g
gpl | gnu general public license|gnu gpl | gnu
lgpl-2 | gnu library general public license(?: version)? 2(?: 0)?|lgpl v? ?2(?: 0)? | l
lgpl-2.1 | gnu lesser general public license(?: version)? 2 1|lgpl v? ?2 1 | l
lgpl-3 | gnu lesser general public license(?: version)? 3(?: 0)?|lgpl v? ?3(?: 0)? | l
lgpl | gnu lesser general public license|gnu lgpl | gnu
agpl-3 | gnu affero general public license(?: version)? 3(?: 0)?|agpl v? ?3(?: 0)? | a
agpl | gnu affero general public license|gnu agpl | gnu
gfdl-1.1 | gnu free documentation license(?: version)? 1 1|gfdl 1 1 | g
gfdl-1.2 | gnu free documentation license(?: version)? 1 2|gfdl 1 2 | g
gfdl-1.3 | gnu free documentation license(?: version)? 1 3|gfdl 1 3 | g
mpl-1.1 | mozilla public license(?: version)? 1 1|mpl 1 1 | m
mpl-2 | mozilla public license(?: version)? 2(?: 0)?|mpl 2 0 | m
epl-1 | eclipse public license(?: version)? 1(?: 0)?|epl 1 0 | e
epl-2 | eclipse public license(?: version)? 2(?: 0)?|epl 2 0 | e
cddl-1 | common development and distribution license(?: version)? ?1?(?: 0)?|cddl 1 0 | c
cpl-1 | common public license(?: version)? 1 0|cpl 1 0 | c
ms-pl | microsoft public license|ms pl | m
ms-rl | microsoft reciprocal license|ms rl | m
artistic-1 | artistic license(?: version)? 1(?: 0)?|artistic 1 0 | artistic
artistic-2 | artistic license(?: version)? 2(?: 0)?|artistic 2 0 | artistic
perl | perl artistic|same terms as perl(?: itself)? | perl
python-2 | python software foundation license(?: version)? ?2?|psf license|python license | p
php-3 | php license(?: version)? 3(?: 0 1| 01)? | php
ruby | ruby license|ruby s license | ruby
ofl-1.1 | sil open font license(?: version)? ?1? ?1?|ofl 1 1 | o
postgresql | postgresql license | postgresql
ncsa | university of illinois ncsa open source license|ncsa open source license | ncsa
eupl-1.1 | european union public licen[cs]e(?: v)? ?1 1|eupl 1 1 | e
eupl-1.2 | european union public licen[cs]e(?: v)? ?1 2|eupl 1 2 | e
osl-3 | open software license(?: version)? 3(?: 0)?|osl 3 0 | o
afl-3 | academic free license(?: version)? 3(?: 0)?|afl 3 0 | a
ecl-2 | educational community license(?: version)? 2(?: 0)?|ecl 2 0 | e
qpl-1 | q public license(?: version)? ?1?(?: 0)?|qpl 1 0 | q
vim | vim license | vim
curl | curl license | curl
openssl | openssl license|openssl toolkit license | openssl
sleepycat | sleepycat license | sleepycat
beerware | beer ?ware license|beerware | beer
cecill-2 | cecill(?: free software license)?(?: version)? ?2?(?: 1)? | cecill
odbl-1 | open database license(?: v)? ?1?(?: 0)?|odbl 1 0 | od
pddl-1 | public domain dedication and license|pddl 1 0 | p
cc0-1 | cc0(?: 1 0)?(?: universal)?|creative commons zero(?: v1 0)? | c
cc-by-1 | cc by 1 0|creative commons attribution 1 0 | c
cc-by-2 | cc by 2 0|creative commons attribution 2 0 | c
cc-by-3 | cc by 3 0|creative commons attribution 3 0 | c
cc-by-4 | cc by 4 0|creative commons attribution 4 0 | c
cc-by-sa-2 | cc by sa 2 0|creative commons attribution share ?alike 2 0 | c
cc-by-sa-3 | cc by sa 3 0|creative commons attribution share ?alike 3 0 | c
cc-by-sa-4 | cc by sa 4 0|creative commons attribution share ?alike 4 0 | c
cc-by-nd-4 | cc by nd 4 0|creative commons attribution no ?deriv(?:ative)?s 4 0 | c
cc-by-nc-3 | cc by nc 3 0|creative commons attribution non ?commercial 3 0 | c
cc-by-nc-4 | cc by nc 4 0|creative commons attribution non ?commercial 4 0 | c
cc-by-nc-sa-3 | cc by nc sa 3 0|creative commons attribution non ?commercial share ?alike 3 0 | c
cc-by-nc-sa-4 | cc by nc sa 4 0|creative commons attribution non ?commercial share ?alike 4 0 | c
cc-by-nc-nd-4 | cc by nc nd 4 0|creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0 | c
ogl-uk-3 | open government licen[cs]e(?: v)? ?3(?: 0)?|ogl uk 3 0 | o
elastic-2 | elastic license(?: version)? 2(?: 0)?|elv2 | el
sspl-1 | server side public license(?: version)? ?1?|sspl 1 0 | s
busl-1.1 | business source license(?: version)? 1 1|busl 1 1 | bus
commons-clause | commons clause | commons clause
json | json license | json
"""

#: (suffix of the rule's name, regex around a name, priority: smaller is taken first, confidence)
FORMS = (
    ("tag", r"spdx license identifier (?:{})", 0, 1.0),
    ("grant", r"(?:released|distributed|licensed|available|published|provided|covered|made available|redistribute it)(?: and or modify it)? under(?: the)?(?: terms(?: and conditions)? of)?(?: the)? (?:{})(?: licen[cs]e)?(?: agreement)?(?: version \d+(?: \d+)?)?", 1, 0.95),
    ("under", r"(?:subject to|according to|governed by|see|under)(?: the)?(?: terms of)?(?: the)? (?:{}) licen[cs]e", 2, 0.9),
    ("title", r"(?:the )?(?:{}) licen[cs]e(?: version \d+(?: \d+)?)?", 3, 0.8),
    ("field", r"licen[cs]e (?:is |type |name )?(?:the )?(?:{})", 4, 0.75),
)

#: Rules for whole sentences and addresses: name | label | keyword | priority | confidence | regex
OTHERS = r"""
mit-text | mit | permission is hereby granted | 0 | 1.0 | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
isc-text | isc | permission to use copy modify | 0 | 1.0 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd-text | bsd | redistribution and use in source | 0 | 1.0 | redistribution and use in source and binary forms with or without modification are permitted
gpl-text | gpl | free software you can redistribute | 0 | 1.0 | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
unlicense-text | unlicense | unencumbered | 0 | 1.0 | this is free and unencumbered software released into the public domain
apache-url | apache-2 | apache org | 1 | 0.95 | (?:https? )?www apache org licenses license 2 0
mit-url | mit | opensource org | 1 | 0.95 | (?:https? )?opensource org licenses mit
bsd-url | bsd | opensource org | 1 | 0.95 | (?:https? )?opensource org licenses bsd(?: \d clause)?
gpl-url | gpl | gnu org | 1 | 0.9 | (?:https? )?(?:www )?gnu org licenses(?: old licenses)? gpl(?: \d \d)?
lgpl-url | lgpl | gnu org | 1 | 0.9 | (?:https? )?(?:www )?gnu org licenses(?: old licenses)? lgpl(?: \d \d)?
mpl-url | mpl-2 | mozilla org | 1 | 0.95 | (?:https? )?(?:www )?mozilla org mpl 2 0
cc-url | cc | creativecommons org | 1 | 0.9 | (?:https? )?creativecommons org licenses by(?: nc| sa| nd)* \d \d
cc0-url | cc0-1 | creativecommons org | 1 | 0.9 | (?:https? )?creativecommons org publicdomain zero 1 0
public-domain | public-domain | public domain | 3 | 0.7 | (?:in|into|to) the public domain|public domain dedication
proprietary | proprietary | all rights reserved | 5 | 0.5 | all rights reserved
cc-by-nc | cc-by-nc | cc by nc | 3 | 0.8 | (?:licensed under )?cc by nc
cc-by-sa | cc-by-sa | cc by sa | 3 | 0.8 | (?:licensed under )?cc by sa
cc-by | cc-by | cc by | 4 | 0.7 | (?:licensed under )?cc by
mit-notice | mit | above copyright notice and this permission notice | 1 | 0.95 | the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software
mit-grant | mit | use copy modify merge publish | 1 | 0.95 | (?:including without limitation )?the rights to use copy modify merge publish distribute sublicense and or sell copies
mit-short | mit | mit licen | 4 | 0.7 | mit licen[cs]ed?
x11-names | x11 | x consortium | 2 | 0.9 | except as contained in this notice the name of the x consortium shall not be used in advertising
hpnd-text | hpnd | permission to use copy modify and distribute | 1 | 0.9 | permission to use copy modify and distribute this software and its documentation for any purpose(?: and)?(?: without fee)? is hereby granted(?: without fee)?
isc-short | isc | permission to use copy modify and or distribute | 1 | 0.9 | permission to use copy modify and or distribute this software
0bsd-text | 0bsd | distribute this software for any purpose with or without fee | 2 | 0.8 | distribute this software for any purpose with or without fee is hereby granted
bsd-names | bsd-3-clause | endorse or promote products | 1 | 0.95 | neither the names? of (?:\S+ ){1,12}?may be used to endorse or promote products derived from this software
bsd-ads | bsd-4-clause | all advertising materials mentioning features | 1 | 0.95 | all advertising materials mentioning features or use of this software must display
bsd-source | bsd | redistributions of source code must retain | 2 | 0.9 | redistributions of source code must retain the above copyright notice
bsd-binary | bsd | redistributions in binary form must reproduce | 2 | 0.9 | redistributions in binary form must reproduce the above copyright notice
bsd-style | bsd | bsd style licen | 3 | 0.8 | (?:a )?bsd style licen[cs]e
bsd-patent | bsd-2-clause-patent | perpetual worldwide non exclusive no charge royalty free irrevocable | 2 | 0.8 | perpetual worldwide non exclusive no charge royalty free irrevocable(?: except for failure to satisfy the conditions of this licen[cs]e)? patent licen[cs]e
apache-text | apache-2 | you may not use this file except in compliance | 0 | 1.0 | you may not use this file except in compliance with the licen[cs]e(?: you may obtain a copy of the licen[cs]e at)?
apache-asis | apache-2 | distributed under the license is distributed on an as is | 1 | 0.95 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-terms | apache-2 | terms and conditions for use reproduction and distribution | 1 | 0.95 | terms and conditions for use reproduction and distribution
apache-notice | apache-2 | attribution notices contained within such notice file | 2 | 0.8 | attribution notices contained within such notice file
apache-asf | apache-2 | licensed to the apache software foundation | 0 | 1.0 | licensed to the apache software foundation asf under one or more contributor license agreements
apache-1-name | apache-1.1 | product includes software developed by the apache | 1 | 0.9 | this product includes software developed by the apache software foundation
gpl-or-later-2 | gpl-2-or-later | either version 2 of the license | 0 | 1.0 | either version 2 of the license or at your option any later version
gpl-or-later-3 | gpl-3-or-later | either version 3 of the license | 0 | 1.0 | either version 3 of the license or at your option any later version
gpl-hope | gpl | hope that it will be useful | 1 | 0.9 | distributed in the hope that it will be useful but without any warranty
gpl-received | gpl | received a copy of the gnu general public license | 1 | 0.95 | you should have received a copy of the gnu general public license along with
lgpl-received | lgpl | received a copy of the gnu lesser general public license | 1 | 0.95 | you should have received a copy of the gnu lesser general public license along with
lgpl-old-received | lgpl-2 | received a copy of the gnu library general public license | 1 | 0.95 | you should have received a copy of the gnu library general public license along with
agpl-received | agpl | received a copy of the gnu affero general public license | 1 | 0.95 | you should have received a copy of the gnu affero general public license along with
agpl-network | agpl-3 | remote network interaction | 2 | 0.85 | remote network interaction use with the gnu general public license
gpl-preamble | gpl | free copyleft license for software | 1 | 0.95 | the gnu general public license is a free copyleft license for software and other kinds of works
gpl-2-preamble | gpl-2 | licenses for most software are designed to take away | 1 | 0.95 | the licenses for most software are designed to take away your freedom to share and change it
gpl-classpath | gpl-2-classpath | permission to link this library with independent modules | 1 | 0.95 | (?:give you|grants?) permission to link this library with independent modules
gcc-exception | gpl-3-gcc-exception | gcc runtime library exception | 1 | 0.95 | gcc runtime library exception(?: version \d \d)?
gfdl-text | gfdl | no invariant sections | 1 | 0.9 | with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
mpl-text | mpl-2 | source code form is subject to the terms of the mozilla public license | 0 | 1.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1-text | mpl-1.1 | contents of this file are subject to the mozilla public license | 0 | 1.0 | the contents of this file are subject to the mozilla public license version 1 1
mpl-incompatible | mpl-2-no-copyleft | incompatible with secondary licenses | 0 | 1.0 | this source code form is incompatible with secondary licenses
epl-text | epl | accompanying materials are made available under the terms of the eclipse | 1 | 0.95 | (?:this program and the )?accompanying materials are made available under the terms of the eclipse public license(?: v \d \d| \d \d)?
epl-url | epl | eclipse org legal | 1 | 0.95 | (?:https? )?(?:www )?eclipse org legal epl v\d\d?(?: html)?
edl-url | edl-1 | eclipse org org documents edl | 1 | 0.95 | (?:https? )?(?:www )?eclipse org org documents edl v10(?: php| html)?
cddl-text | cddl-1 | subject to the terms of the common development and distribution license | 0 | 1.0 | the contents of this file are subject to the terms of the common development and distribution license
cddl-url | cddl-1 | opensource org licenses cddl | 1 | 0.95 | (?:https? )?opensource org licenses cddl(?: 1 0)?
zlib-asis | zlib | held liable for any damages arising from the use of this software | 1 | 0.9 | in no event will the authors be held liable for any damages arising from the use of this software
zlib-origin | zlib | origin of this software must not be misrepresented | 1 | 0.95 | the origin of this software must not be misrepresented you must not claim that you wrote the original software
boost-text | boost-1 | obtaining a copy of the software and accompanying documentation covered by this license | 0 | 1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
boost-url | boost-1 | boost org license | 1 | 0.95 | (?:https? )?(?:www )?boost org license 1 0 txt
unlicense-anyone | unlicense | anyone is free to copy modify publish | 1 | 0.95 | anyone is free to copy modify publish use compile sell or distribute this software
unlicense-url | unlicense | unlicense org | 1 | 0.95 | (?:https? )?unlicense org
wtfpl-text | wtfpl | everyone is permitted to copy and distribute verbatim or modified | 1 | 0.95 | everyone is permitted to copy and distribute verbatim or modified copies of this license document
beerware-text | beerware | buy me a beer | 1 | 0.95 | if we meet some day and you think this stuff is worth it you can buy me a beer in return
artistic-text | artistic-1 | semblance of artistic control | 1 | 0.95 | copyright holder maintains some semblance of artistic control over the development of the package
perl-terms | perl | same terms as perl | 1 | 0.9 | (?:you can redistribute it and or modify it )?under the same terms as perl itself
ruby-terms | ruby | same terms as ruby | 1 | 0.9 | under the same terms as ruby(?: itself)?
python-text | python-2 | python software foundation psf and the individual or organization | 0 | 1.0 | this license agreement is between the python software foundation psf and the individual or organization
php-text | php-3 | product includes php software | 1 | 0.9 | this product includes php software freely available from
openssl-text | openssl | openssl project for use in the openssl toolkit | 1 | 0.95 | developed by the openssl project for use in the openssl toolkit
ssleay-text | ssleay | cryptographic software written by eric young | 1 | 0.95 | this product includes cryptographic software written by eric young
postgresql-text | postgresql | university of california be liable to any party | 1 | 0.9 | in no event shall the university of california be liable to any party
ncsa-text | ncsa | deal with the software without restriction | 1 | 0.9 | to deal with the software without restriction including without limitation the rights
ofl-text | ofl-1.1 | reserved font name | 1 | 0.9 | (?:with )?reserved font name
ofl-url | ofl-1.1 | scripts sil org ofl | 1 | 0.95 | (?:https? )?scripts sil org ofl
eupl-text | eupl | eupl | 2 | 0.85 | (?:licensed under|under the terms of) the eupl
eupl-url | eupl | joinup ec europa eu | 1 | 0.9 | (?:https? )?joinup ec europa eu(?: \S+){0,6} eupl
osl-text | osl-3 | open software license version 3 | 0 | 1.0 | licensed under the open software license version 3 0
afl-text | afl-3 | academic free license version 3 | 0 | 1.0 | licensed under the academic free license version 3 0
ms-pl-text | ms-pl | accept this license if you do not accept | 2 | 0.8 | if you use the software you accept this license if you do not accept the license do not use the software
sspl-service | sspl-1 | making the program available to third parties as a service | 1 | 0.95 | making the program available to third parties as a service
busl-change | busl-1.1 | change date | 2 | 0.85 | change date (?:\S+ ){1,8}?change license
busl-grant | busl-1.1 | additional use grant | 2 | 0.85 | additional use grant
commons-clause-text | commons-clause | right to sell the software | 1 | 0.9 | does not grant to you the right to sell the software
elastic-limits | elastic-2 | hosted or managed service | 1 | 0.9 | you may not provide the software to third parties as a hosted or managed service
json-good | json | shall be used for good not evil | 0 | 1.0 | the software shall be used for good not evil
hippocratic | hippocratic | hippocratic license | 2 | 0.9 | (?:the )?hippocratic license(?: version)?(?: \d(?: \d)?)?
blueoak | blueoak-1 | blue oak model license | 2 | 0.95 | (?:the )?blue oak model license(?: 1 0 0)?
mulan | mulan-psl | mulan psl | 2 | 0.95 | mulan psl ?v\d|mulan permissive software license(?: version)? \d mulan psl
unicode | unicode | unicode data files | 2 | 0.9 | unicode data files and software
ijg | ijg | independent jpeg group | 2 | 0.9 | based in part on the work of the independent jpeg group
freetype | ftl | freetype | 2 | 0.9 | portions of this software are copyright (?:\S+ ){0,3}the freetype (?:project|team)(?: freetype team)?|the freetype team
llama-community | llama-community | community license | 1 | 0.95 | (?:the )?(?:meta )?(?:llama \d (?:\d )?community|llama community) license(?: agreement)?|llama community license
openrail | openrail | responsible ai license | 1 | 0.9 | (?:creative ml )?open ?rail(?: [mspd])?(?: plus plus)? responsible ai license|responsible ai license
odc-by | odc-by-1 | open data commons attribution | 1 | 0.95 | open data commons attribution license(?: v ?1 0)?
odbl-text | odbl-1 | made available under the open database license | 0 | 1.0 | made available under the open database license
pddl-text | pddl-1 | open data commons public domain | 1 | 0.95 | open data commons public domain dedication(?: and)? licen[cs]e
cdla | cdla | community data license agreement | 1 | 0.95 | community data license agreement (?:permissive|sharing)(?: version)? \d \d
cc-legal | cc | creative commons corporation is not a law firm | 1 | 0.9 | creative commons corporation is not a law firm
cc-licensed | cc | licensed under a creative commons | 1 | 0.85 | (?:this work )?is licensed under a creative commons
cc-by-text | cc-by | licensed under a creative commons attribution | 0 | 0.95 | is licensed under a creative commons attribution (?:\d \d )?(?:international |unported |generic )?licen[cs]e
cc-by-sa-text | cc-by-sa | licensed under a creative commons attribution share | 0 | 0.95 | is licensed under a creative commons attribution share ?alike(?: \d \d)?
cc-by-nc-text | cc-by-nc | licensed under a creative commons attribution non | 0 | 0.95 | is licensed under a creative commons attribution non ?commercial (?:\d \d|licen[cs]e)
cc-by-nc-nd | cc-by-nc-nd | cc by nc nd | 2 | 0.85 | (?:licensed under )?cc by nc nd
cc-by-nc-sa | cc-by-nc-sa | cc by nc sa | 2 | 0.85 | (?:licensed under )?cc by nc sa
cc-by-nd | cc-by-nd | cc by nd | 2 | 0.85 | (?:licensed under )?cc by nd
cc0-waiver | cc0-1 | waived all copyright and related | 0 | 1.0 | (?:has|have) waived all copyright and related or neighboring rights
cc0-dedicated | cc0-1 | dedicated the work to the public domain | 0 | 1.0 | dedicated the work to the public domain by waiving
pd-mark | public-domain | free of known copyright restrictions | 1 | 0.9 | free of known copyright restrictions
pd-government | public-domain | work of the united states government | 2 | 0.8 | work of the united states government(?: and is)?(?: not subject to copyright)?
dual | dual | dual licensed under | 2 | 0.8 | dual licensed under
proprietary-confidential | proprietary | proprietary and confidential | 3 | 0.7 | (?:is )?proprietary and confidential
proprietary-copying | proprietary | unauthorized copying of this file | 2 | 0.8 | unauthorized copying of this file via any medium is strictly prohibited
proprietary-permission | proprietary | without the prior written permission | 4 | 0.5 | without the prior written permission of
non-commercial | non-commercial | non commercial | 4 | 0.5 | for (?:personal and |personal or )?non commercial (?:use|purposes) only
research-only | research-only | research purposes only | 4 | 0.5 | (?:for )?(?:academic |non commercial )?research purposes only
mit-0-text | mit-0 | to permit persons to whom the software is furnished to do so the software is provided | 2 | 0.7 | permission is hereby granted (?:\S+ ){1,60}?to permit persons to whom the software is furnished to do so the software is provided
x11-advertising | x11 | shall not be used in advertising or otherwise to promote | 1 | 0.9 | shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization
x11-trademark | x11 | x window system is a trademark | 2 | 0.9 | x window system is a trademark of (?:the open group|x consortium inc)
apache-1-acknowledgment | apache-1.1 | end user documentation included with the redistribution | 1 | 0.95 | the end user documentation included with the redistribution if any must include the following acknowledgment
apache-1-names | apache-1.1 | must not be used to endorse or promote products derived from this software without prior written permission for written permission | 1 | 0.9 | must not be used to endorse or promote products derived from this software without prior written permission for written permission please contact
bsd-freebsd-views | bsd-2-clause | interpreted as representing official policies | 1 | 0.95 | should not be interpreted as representing official policies either expressed or implied of
bsd-disclaimer | bsd | in no event shall the copyright | 3 | 0.8 | in no event shall the copyright (?:holders?|owner) or contributors be liable for any direct indirect incidental special exemplary or consequential damages
bsd-regents | bsd-4-clause | regents of the university of california | 3 | 0.7 | (?:copyright c )?(?:\d{4} )*the regents of the university of california
libpng-order | libpng | png reference library | 1 | 0.95 | (?:the )?png reference library is supplied as is
libpng-altered | libpng | must not be misrepresented as being the original | 2 | 0.85 | altered (?:source )?versions must be plainly marked as such and must not be misrepresented as being the original (?:source|software)
zlib-express | zlib | provided as is without any express or implied warranty | 3 | 0.7 | this software is provided as is without any express or implied warranty
isc-disclaim | isc | disclaims all warranties with regard to this software | 2 | 0.85 | disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
gpl-1-text | gpl-1 | either version 1 or at your option | 1 | 0.9 | either version 1 or at your option any later version
gpl-2-only | gpl-2 | version 2 of the license only | 0 | 0.95 | (?:only )?version 2 of the license only
gpl-2-address | gpl-2 | 51 franklin street | 2 | 0.8 | free software foundation inc 51 franklin street fifth floor boston
gpl-old-address | gpl-2 | 59 temple place | 2 | 0.8 | free software foundation inc 59 temple place suite 330 boston
gpl-3-install | gpl-3 | installation information | 2 | 0.7 | installation information for a user product
gpl-3-tivo | gpl-3 | protecting users legal rights from anti circumvention law | 1 | 0.95 | protecting users legal rights from anti circumvention law
gpl-3-received-url | gpl-3 | gnu org licenses | 3 | 0.6 | if not see (?:https? )?www gnu org licenses
gpl-share | gpl | guarantee your freedom to share and change | 1 | 0.9 | intended to guarantee your freedom to share and change
lgpl-2-preamble | lgpl-2 | library general public license applies to some specially designated | 1 | 0.95 | this license the library general public license applies to some specially designated free software foundation software
lgpl-2.1-preamble | lgpl-2.1 | lesser general public license applies to some specially designated | 1 | 0.95 | this license the lesser general public license applies to some specially designated software packages
lgpl-2.1-either | lgpl-2.1-or-later | either version 2 1 of the license | 0 | 1.0 | either version 2 1 of the license or at your option any later version
lgpl-3-additional | lgpl-3 | supplemented by the additional permissions | 1 | 0.9 | incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below
lgpl-combined | lgpl | combined work | 3 | 0.7 | convey a combined work under terms of your choice
agpl-cooperation | agpl-3 | cooperation with the community in the case of network server software | 1 | 0.95 | specifically designed to ensure cooperation with the community in the case of network server software
agpl-offer | agpl-3 | interacting with it remotely through a computer network | 1 | 0.95 | prominently offer all users interacting with it remotely through a computer network
gfdl-preamble | gfdl | functional and useful document free in the sense of freedom | 1 | 0.95 | functional and useful document free in the sense of freedom
gfdl-copy | gfdl | permission is granted to copy distribute and or modify this document | 1 | 0.95 | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license(?: version \d \d)?
mpl-copyleft | mpl-2 | covered software is provided under this license on an as is basis | 1 | 0.95 | covered software is provided under this license on an as is basis without warranty of any kind
mpl-1-alternatively | mpl-1.1 | alternatively the contents of this file may be used | 1 | 0.9 | alternatively the contents of this file may be used under the terms of either
mpl-1-initial | mpl-1.1 | initial developer of the original code | 2 | 0.85 | the initial developer of the original code is
mpl-obtain | mpl-2 | obtain one at | 3 | 0.7 | if a copy of the mpl was not distributed with this file you can obtain one at
epl-1-agreement | epl-1 | eclipse public license agreement | 1 | 0.9 | accompanying program is provided under the terms of this eclipse public license agreement
epl-2-secondary | epl-2 | satisfied gnu general public license | 1 | 0.9 | set forth in the eclipse public license v 2 0 are satisfied gnu general public license
cpl-agreement | cpl-1 | terms of this common public license | 1 | 0.95 | accompanying program is provided under the terms of this common public license
cddl-executable | cddl-1 | covered software that you distribute or otherwise make available in executable form | 1 | 0.95 | any covered software that you distribute or otherwise make available in executable form must also be made available in source code form
ms-rl-file | ms-rl | for any file you distribute that contains code from the software | 1 | 0.95 | for any file you distribute that contains code from the software in source code or binary format you must provide
ms-pl-grant | ms-pl | each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce | 1 | 0.9 | each contributor grants you a non exclusive worldwide royalty free copyright license to reproduce its contribution
artistic-2-standard | artistic-2 | artistic license is intended | 1 | 0.9 | this artistic license is intended to (?:\S+ ){1,20}?maintain some artistic control
artistic-2-preserve | artistic-2 | package to remain available as open source and free software | 1 | 0.9 | support and development of the package to remain available as open source and free software
artistic-1-reuse | artistic-1 | freely available means that no fee is charged for the item itself | 1 | 0.95 | freely available means that no fee is charged for the item itself
python-summary | python-2 | prepare derivative works distribute and otherwise use python | 2 | 0.8 | to reproduce analyze test perform and or display publicly prepare derivative works distribute and otherwise use python
php-name | php-3 | products derived from this software may not be called php | 1 | 0.95 | products derived from this software may not be called php nor may php appear in their name
ruby-conditions | ruby | place your modifications in the public domain or otherwise make them freely available | 1 | 0.9 | place your modifications in the public domain or otherwise make them freely available
ofl-goals | ofl-1.1 | goals of the open font license | 1 | 0.95 | the goals of the open font license ofl are to stimulate worldwide development
ofl-sold | ofl-1.1 | font software nor any of its individual components | 1 | 0.95 | neither the font software nor any of its individual components in original or modified versions may be sold by itself
postgresql-grant | postgresql | modify and distribute this software and its documentation for any purpose without fee and without a written agreement | 1 | 0.95 | modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
ncsa-names | ncsa | nor the names of its contributors may be used to endorse or promote products derived from this software without specific | 2 | 0.85 | nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
eupl-notice | eupl | european union public licen | 1 | 0.9 | (?:licensed under|this) (?:the )?european union public licen[cs]e(?: the eupl)?
osl-external | osl-3 | external deployment | 1 | 0.9 | the term external deployment means the use distribution or communication of the original work
afl-attribution | afl-3 | retain in the source code of any derivative works | 2 | 0.85 | you must retain in the source code of any derivative works that you create all copyright patent or trademark notices
ecl-patent | ecl-2 | any patent license granted herein with respect to | 1 | 0.95 | any patent license granted herein with respect to (?:contributions by )?an individual(?:s)? employed by organizations
qpl-items | qpl-1 | separate from the software such as patches | 1 | 0.9 | in a form that is separate from the software such as patches|forms which are separate from the software such as patches
vim-changes | vim | vim maintainer | 1 | 0.9 | (?:make them available to the|send it to the) vim maintainer
vim-charity | vim | children in uganda | 2 | 0.8 | (?:help|helping) (?:needy |poor )?children in uganda
curl-notice | curl | copyright c 1996 | 2 | 0.7 | copyright c 1996 (?:\d{4} )?daniel stenberg
openssl-names | openssl | openssl toolkit and openssl project must not be used | 1 | 0.95 | the names openssl toolkit and openssl project must not be used to endorse or promote
sleepycat-source | sleepycat | accompanying software that uses the db software | 1 | 0.95 | complete source code for the db software and any accompanying software that uses the db software
cecill-principles | cecill-2 | cea cnrs | 1 | 0.9 | (?:agreement is|license as circulated by) (?:\S+ ){0,10}?cea cnrs (?:and )?inria|circulated by cea cnrs (?:and )?inria
odbl-share | odbl-1 | database contents license | 2 | 0.8 | rights in individual contents of the database are licensed under the database contents license
pddl-rightsholder | pddl-1 | rightsholder | 2 | 0.7 | the rightsholder (?:irrevocably )?(?:dedicates|places) (?:by dedicating )?the work to the public domain
cc-deed-share | cc-by-sa | distribute your contributions under the same license as the original | 1 | 0.9 | you must distribute your contributions under the same license as the original
cc-deed-nc | cc-by-nc | may not use the material for commercial purposes | 1 | 0.9 | you may not use the material for commercial purposes
cc-deed-nd | cc-by-nd | may not distribute the modified material | 1 | 0.9 | if you remix transform or build upon the material you may not distribute the modified material
cc-deed-by | cc-by | give appropriate credit provide a link to the license | 1 | 0.9 | you must give appropriate credit provide a link to the license and indicate if changes were made
cc-url-sa | cc-by-sa | creativecommons org licenses by sa | 0 | 0.95 | (?:https? )?creativecommons org licenses by sa \d \d
cc-url-nc | cc-by-nc | creativecommons org licenses by nc | 0 | 0.95 | (?:https? )?creativecommons org licenses by nc \d \d
cc-url-nc-sa | cc-by-nc-sa | creativecommons org licenses by nc sa | 0 | 0.95 | (?:https? )?creativecommons org licenses by nc sa \d \d
cc-url-nc-nd | cc-by-nc-nd | creativecommons org licenses by nc nd | 0 | 0.95 | (?:https? )?creativecommons org licenses by nc nd \d \d
cc-url-nd | cc-by-nd | creativecommons org licenses by nd | 0 | 0.95 | (?:https? )?creativecommons org licenses by nd \d \d
cc0-extent | cc0-1 | to the extent possible under law | 1 | 0.9 | to the extent possible under law (?:\S+ ){1,12}?has waived
ogl-acknowledge | ogl-uk-3 | public sector information licensed under the open government licen | 0 | 0.95 | contains public sector information licensed under the open government licen[cs]e(?: v3 0)?
elastic-circumvent | elastic-2 | license key functionality | 1 | 0.95 | you may not move change disable or circumvent the license key functionality
sspl-section | sspl-1 | service source code | 1 | 0.9 | you must make the service source code available
busl-non-production | busl-1.1 | make non production use of the licensed work | 1 | 0.95 | make non production use of the licensed work
polyform | polyform | polyform | 1 | 0.95 | polyform (?:noncommercial|shield|small business|free trial|internal use|perimeter|strict) licen[cs]e(?: \d \d \d)?
prosperity | prosperity | prosperity public license | 1 | 0.95 | (?:the )?prosperity public license(?: \d \d \d)?
parity | parity | parity public license | 1 | 0.95 | (?:the )?parity public license(?: \d \d \d)?
upl | upl-1 | universal permissive license | 1 | 0.95 | (?:the )?universal permissive license(?: upl)?(?: version)?(?: 1 0)?
ecos | ecos-2 | ecos is distributed | 1 | 0.9 | ecos is distributed in the hope that it will be useful
ipl | ipl-1 | ibm public license | 1 | 0.95 | (?:the )?ibm public license(?: version)?(?: 1 0)?
lppl | lppl | latex project public license | 1 | 0.95 | (?:the )?latex project public license(?: (?:either )?version)?(?: 1 \d)?
rpl | rpl | reciprocal public license | 1 | 0.95 | (?:the )?reciprocal public license(?: version)?(?: 1 [15])?
spl | spl-1 | sun public license | 1 | 0.95 | (?:the )?sun public license(?: version)?(?: 1 0)?
nposl | nposl-3 | non profit open software license | 0 | 0.95 | (?:the )?non profit open software license(?: version)?(?: 3 0)?
w3c | w3c | w3c software notice | 1 | 0.95 | w3c software notice and (?:document )?licen[cs]e
icu | icu | icu license | 1 | 0.9 | icu license icu 1 8 1 and later
intel | intel | intel open source licen | 1 | 0.9 | intel open source licen[cs]e
nasa | nasa-1.3 | nasa open source agreement | 1 | 0.95 | nasa open source agreement(?: version)?(?: 1 3)?
watcom | watcom-1 | sybase open watcom public license | 1 | 0.95 | sybase open watcom public license(?: version)?(?: 1 0)?
zpl | zpl | zope public license | 1 | 0.95 | (?:the )?zope public license(?: zpl)?(?: version)?(?: 2 [01])?
gemma-terms | gemma | gemma terms of use | 1 | 0.9 | gemma terms of use
falcon | falcon | falcon | 1 | 0.9 | falcon (?:180b )?tii license|falcon llm licen[cs]e
"""


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: bytes
    also: tuple[bytes, ...]
    priority: int
    confidence: float
    regex: re.Pattern


def rules() -> list[Rule]:
    """All rules in order of priority."""
    out = []
    for line in NAMES.strip().split("\n"):
        label, names, keyword = (x.strip() for x in line.split(" | "))
        for form, frame, priority, confidence in FORMS:
            need = keyword if len(keyword) > 2 else "spdx" if form == "tag" else "under" if form == "grant" else "licen"
            out.append(Rule(f"{label}:{form}", label, need.encode(), literals(names), priority, confidence, re.compile(f" (?:{frame.format(names)})(?= )".encode())))
    for line in OTHERS.strip().split("\n"):
        name, label, keyword, priority, confidence, regex = (x.strip() for x in line.split(" | "))
        out.append(Rule(name, label, keyword.encode(), (), int(priority), float(confidence), re.compile(f" (?:{regex})(?= )".encode())))
    return sorted(out, key=lambda r: (r.priority, r.name))


def literals(regex: str) -> tuple[bytes, ...]:
    """What each alternative of a name begins with, up to the first character that does not stand for itself: every match
    holds one of them. Empty if an alternative begins with no such character."""
    out = []
    for part in _alternatives(regex):
        stem = re.match(r"[^\\.^$*+?{}\[\]|()]*", part)[0]
        if part[len(stem) : len(stem) + 1] in ("?", "*", "{"):
            stem = stem[:-1]  # may be missing
        out.append(stem.strip().encode())
    return tuple(out) if all(out) else ()


def _alternatives(regex: str) -> list[str]:
    """The parts of a regex between bars that stand in no bracket."""
    parts, depth = [""], 0
    for c in regex:
        depth += (c in "([") - (c in ")]")
        if c == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += c
    return parts


class Covered:
    """Intervals taken so far, asked whether one of them holds another; a tree of largest ends over starts."""

    def __init__(self, starts: list[int]):
        self.place = {a: i for i, a in enumerate(sorted(set(starts)), 1)}
        self.ends = [0] * (len(self.place) + 1)

    def add(self, a: int, b: int) -> None:
        i = self.place[a]
        while i < len(self.ends):
            self.ends[i] = max(self.ends[i], b)
            i += i & -i

    def holds(self, a: int, b: int) -> bool:
        i, end = self.place[a], 0
        while i:
            end = max(end, self.ends[i])
            i -= i & -i
        return end >= b


class Scanner:
    def __init__(self):
        self.by_keyword: dict[bytes, list[Rule]] = {}
        for r in rules():
            self.by_keyword.setdefault(r.keyword, []).append(r)
        # every keyword of the rules, found in one pass over a text
        self.keywords = ahocorasick.Automaton()
        for k in {*self.by_keyword, *(x for own in self.by_keyword.values() for r in own for x in r.also)}:
            self.keywords.add_word(k.decode("latin-1"), k)
        self.keywords.make_automaton()
        self.base = [(b" " + p.encode() + b" ", label) for p, label in BASE.items()]

    def detections(self, joined: bytes, spaces: np.ndarray) -> list[tuple[int, int, Rule]]:
        """Detections that stay, as (first word, word after the last, rule). spaces: places of blanks; word i is behind the i-th."""
        seen = {k for _, k in self.keywords.iter(joined.decode("latin-1"))}  # one character a byte
        found = []
        for keyword in seen:
            for r in self.by_keyword.get(keyword, ()):
                if not r.also or not seen.isdisjoint(r.also):
                    spans = [m.span() for m in r.regex.finditer(joined)]
                    if spans:
                        places = np.searchsorted(spaces, np.array(spans))
                        found += [(a, b, r) for a, b in places.tolist()]
        found.sort(key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].name))
        taken, kept = Covered([a for a, _, _ in found]), []
        for a, b, r in found:
            if not taken.holds(a, b):
                taken.add(a, b)
                kept.append((a, b, r))
        return sorted(kept, key=lambda x: x[:2])

    def scan(self, text: str | None) -> tuple:
        words = (text or "").encode().translate(_TABLE).split()
        joined = b" " + b" ".join(words) + b" "
        spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts, labels = [], set()
        for phrase, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                starts.append(at)
                labels.add(label)
                at = joined.find(phrase, at + 1)
        places = np.searchsorted(spaces, starts).tolist() if starts else []
        kept = self.detections(joined, spaces)
        score = max([r.confidence for *_, r in kept] + [0.9] * bool(places), default=0.0)
        return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {r.label for *_, r in kept})), score, [f"{a}-{b}:{r.name}" for a, b, r in kept]


_scanner: list[Scanner] = []


def scanner() -> Scanner:
    """One for each worker process."""
    if not _scanner:
        _scanner.append(Scanner())
    return _scanner[0]


def license_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and detections.

    Ids are whole numbers, given as long. detections: array of "first-end:rule" word intervals after suppression. score: the largest confidence of what stays.
    """
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scanner().scan(t) for t in batch.column("text").to_pylist()]
            cols = [pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<string>"
    )
