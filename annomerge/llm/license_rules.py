"""Signature rules of the license scan, by hand, most specific first within a keyword.

A line is label, keyword and pattern between bars. Text is matched as lower-cased words between single spaces; the keyword
stands in every match, as whole words. {L} is licence or license, {v} an optional word for version, {later} what lets a
reader choose a later version. An earlier rule outranks a later one of the same stretch.
"""

PARTS = {"{L}": "licen[cs]e", "{v}": "(?:version |v |v)?", "{later}": "(?: only| or (?:at your option )?(?:any )?later(?: version)?)?"}

RULES = """
apache-2 | apache | (?:licensed|released|distributed) under the (?:terms of the )?apache {L} version 2 0(?: the {L})?
apache-2 | apache | http www apache org licenses license 2 0(?: txt| html)?
apache-2 | apache | https www apache org licenses license 2 0(?: txt| html)?
apache-2 | apache | spdx {L} identifier apache 2 0
apache-2 | apache | apache {L} version 2 0 january 2004
apache-2 | apache | apache(?: software)? {L} {v}2(?: 0)?
apache-2 | apache | apache 2(?: 0)? {L}
apache-2 | apache | apache 2 0
apache-1.1 | apache | (?:licensed|released|distributed) under the (?:terms of the )?apache(?: software)? {L} version 1 1
apache-1.1 | apache | the apache software {L} version 1 1
apache-1.1 | apache | spdx {L} identifier apache 1 1
apache-1.1 | apache | apache(?: software)? {L} {v}1 1
apache-1.0 | apache | apache(?: group)? {L} {v}1 0
apache | apache | (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?apache {L}
apache | apache | apache style {L}
apache | apache | apache(?: software)?(?: foundation)? {L}
mit-0 | mit | mit no attribution(?: {L})?
mit-0 | mit | spdx {L} identifier mit 0
mit | mit | (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?mit {L}
mit | mit | (?:this|the) (?:software|project|code|library|work) is (?:under|licensed under|covered by|subject to) the mit {L}
mit | mit | spdx {L} identifier mit
mit | mit | https opensource org licenses mit
mit | mit | http www opensource org licenses mit {L}(?: php)?
mit | mit | (?:dual )?licensed under the mit and gpl {L}s?
mit | mit | mit expat {L}
mit | mit | mit style {L}
mit | mit | mit {L}
mit | mit | {L} mit
mit | expat | expat {L}
mit | free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | free of charge | permission is hereby granted free of charge to any person obtaining a copy
x11 | x11 | (?:mit )?x11 {L}
x11 | x consortium | x consortium {L}
x11 | x consortium | except as contained in this notice the name of the x consortium shall not be used
gpl-3 | gnu | gnu general public {L}(?: gpl)? as published by the free software foundation either version 3 of the {L} or at your option any later version
gpl-3 | gnu | gnu general public {L} version 3 29 june 2007
gpl-3 | gnu | https www gnu org licenses gpl 3 0(?: html| txt| en html)?
gpl-3 | gnu | gnu general public {L}(?: gpl)? {v}3(?: 0)?{later}
gpl-3 | gnu | gnu gpl {v}3(?: 0)?{later}
gpl-2 | gnu | gnu general public {L}(?: gpl)? as published by the free software foundation either version 2 of the {L} or at your option any later version
gpl-2 | gnu | gnu general public {L} version 2 as published by the free software foundation
gpl-2 | gnu | gnu general public {L} version 2 june 1991
gpl-2 | gnu | https www gnu org licenses old licenses gpl 2 0(?: html| txt| en html)?
gpl-2 | gnu | gnu general public {L}(?: gpl)? {v}2(?: 0)?{later}
gpl-2 | gnu | gnu gpl {v}2(?: 0)?{later}
gpl-1 | gnu | gnu general public {L}(?: gpl)? {v}1(?: 0)?{later}
lgpl-3 | gnu | gnu lesser general public {L}(?: lgpl)? as published by the free software foundation either version 3 of the {L} or at your option any later version
lgpl-3 | gnu | gnu lesser general public {L}(?: lgpl)? {v}3(?: 0)?{later}
lgpl-3 | gnu | gnu lgpl {v}3(?: 0)?{later}
lgpl-2.1 | gnu | gnu lesser general public {L}(?: lgpl)? as published by the free software foundation either version 2 1 of the {L} or at your option any later version
lgpl-2.1 | gnu | gnu lesser general public {L}(?: lgpl)? {v}2 1{later}
lgpl-2.1 | gnu | gnu lgpl {v}2 1{later}
lgpl-2 | gnu | gnu library general public {L}(?: lgpl)? as published by the free software foundation either version 2 of the {L} or at your option any later version
lgpl-2 | gnu | gnu library general public {L}(?: lgpl)? {v}2(?: 0)?{later}
agpl-3 | gnu | gnu affero general public {L}(?: agpl)? as published by the free software foundation either version 3 of the {L} or at your option any later version
agpl-3 | gnu | gnu affero general public {L}(?: agpl)? {v}3(?: 0)?{later}
agpl-3 | gnu | gnu agpl {v}3(?: 0)?{later}
gfdl-1.3 | gnu | gnu free documentation {L}(?: gfdl)? {v}1 3{later}
gfdl-1.2 | gnu | gnu free documentation {L}(?: gfdl)? {v}1 2{later}
gfdl-1.1 | gnu | gnu free documentation {L}(?: gfdl)? {v}1 1{later}
gfdl | gnu | gnu free documentation {L}
agpl | gnu | gnu affero general public {L}
lgpl | gnu | gnu (?:lesser|library) general public {L}
gpl | gnu | (?:released|distributed|licensed) under the (?:terms of the )?gnu (?:general public {L}|gpl)
gpl | gnu | redistribute it and or modify it under the terms of the gnu general public {L}
gpl | gnu | gnu (?:general public {L}|gpl)
lgpl-2.1 | lesser general public | lesser general public {L} {v}2 1{later}
lgpl-3 | lesser general public | lesser general public {L} {v}3(?: 0)?{later}
lgpl | lesser general public | lesser general public {L}
lgpl | library general public | library general public {L}
agpl-3 | affero | affero general public {L} {v}3(?: 0)?{later}
agpl-1 | affero | affero general public {L} {v}1(?: 0)?{later}
agpl | affero | affero general public {L}
agpl | affero | affero gpl
gpl-3 | general public | general public {L} {v}3(?: 0)?{later}
gpl-2 | general public | general public {L} {v}2(?: 0)?{later}
gpl | general public | general public {L}
gpl-3 | gpl | spdx {L} identifier gpl 3 0(?: only| or later)?
gpl-2 | gpl | spdx {L} identifier gpl 2 0(?: only| or later)?
gpl-3 | gpl | (?:released|distributed|licensed|available) under (?:the )?gpl {v}3(?: 0)?{later}
gpl-2 | gpl | (?:released|distributed|licensed|available) under (?:the )?gpl {v}2(?: 0)?{later}
gpl-3 | gpl | gpl {v}3(?: 0)?{later}
gpl-2 | gpl | gpl {v}2(?: 0)?{later}
gpl | gpl | (?:released|distributed|licensed|available) under (?:the )?gpl
gpl | gpl | gpl compatible {L}
gpl | gpl | gpl
gpl-3 | gplv3 | gplv3(?: or later)?
gpl-2 | gplv2 | gplv2(?: or later| with classpath exception)?
lgpl-2.1 | lgpl | lgpl {v}2 1{later}
lgpl-3 | lgpl | lgpl {v}3(?: 0)?{later}
lgpl | lgpl | lgpl
lgpl-3 | lgplv3 | lgplv3
lgpl-2.1 | lgplv2 | lgplv2(?: 1)?
agpl-3 | agpl | agpl {v}3(?: 0)?{later}
agpl | agpl | agpl
agpl-3 | agplv3 | agplv3
gfdl | free documentation | free documentation {L}
gfdl | gfdl | gfdl(?: 1 [123])?
bsd-3-clause | bsd | spdx {L} identifier bsd 3 clause
bsd-2-clause | bsd | spdx {L} identifier bsd 2 clause
bsd-3-clause | bsd | (?:new|revised|modified) bsd {L}
bsd-2-clause | bsd | (?:simplified|freebsd) bsd {L}
bsd-4-clause | bsd | (?:original|old) bsd {L}
bsd-3-clause | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd)(?: (?:new|revised))?(?: {L})?
bsd-2-clause | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd)(?: simplified)?(?: {L})?
bsd-4-clause | bsd | (?:bsd 4 clause|4 clause bsd|four clause bsd)(?: {L})?
bsd-0-clause | bsd | (?:zero clause bsd|bsd zero clause)(?: {L})?
bsd | bsd | (?:released|distributed|licensed|available) under (?:the |a )?bsd(?: style)? {L}
bsd | bsd | bsd(?: style| type| like)? {L}
bsd | bsd | {L} bsd
bsd-0-clause | 0bsd | 0bsd
bsd-2-clause | freebsd | freebsd {L}
bsd-3-clause | endorse or promote products | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
isc | isc | spdx {L} identifier isc
isc | isc | (?:released|distributed|licensed|available) under (?:the )?isc {L}
isc | isc | isc {L}
isc | with or without fee | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | with or without fee | permission to use copy modify and distribute this software for any purpose with or without fee
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public {L} v 2 0
mpl-2.0 | mozilla | https mozilla org mpl 2 0
mpl-2.0 | mozilla | mozilla public {L} {v}2(?: 0)?
mpl-1.1 | mozilla | subject to the mozilla public {L} version 1 1
mpl-1.1 | mozilla | mozilla public {L} {v}1 1
mpl-1.0 | mozilla | mozilla public {L} {v}1 0
mpl | mozilla | mozilla public {L}
mpl-2.0 | mpl | spdx {L} identifier mpl 2 0
mpl-2.0 | mpl | mpl {v}2(?: 0)?
mpl-1.1 | mpl | mpl {v}1 1
epl-2.0 | eclipse | eclipse public {L} {v}2(?: 0)?
epl-1.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public {L} v1 0
epl-1.0 | eclipse | eclipse public {L} {v}1(?: 0)?
epl | eclipse | eclipse public {L}
edl-1.0 | eclipse | eclipse distribution {L}(?: {v}1 0)?
epl-2.0 | epl | epl {v}2(?: 0)
epl-1.0 | epl | epl {v}1(?: 0)
cpl-1.0 | common public | common public {L}(?: {v}1 0)?
cpal-1.0 | common public attribution | common public attribution {L}(?: {v}1 0)?
ibmpl-1.0 | ibm public | ibm public {L}(?: {v}1 0)?
cddl-1.1 | common development | common development and distribution {L}(?: cddl)? {v}1 1
cddl-1.0 | common development | common development and distribution {L}(?: cddl)? {v}1 0
cddl | common development | common development and distribution {L}
cddl-1.1 | cddl | cddl {v}1 1
cddl-1.0 | cddl | cddl {v}1 0
cddl | cddl | cddl
ms-pl | microsoft | microsoft public {L}(?: ms pl)?
ms-rl | microsoft | microsoft reciprocal {L}(?: ms rl)?
ms-limited | microsoft | microsoft (?:limited|software|reference source) {L}(?: terms)?
ms-pl | ms | ms pl
ms-rl | ms | ms rl
artistic-2.0 | artistic | artistic {L} {v}2(?: 0)?
artistic-1.0 | artistic | artistic {L} {v}1(?: 0)?
artistic | artistic | (?:perl |clarified )?artistic {L}
perl | perl | (?:under|on) the same terms as (?:the )?perl(?: 5)?(?: programming language system)?(?: itself)?
osl-3.0 | open software | open software {L}(?: osl)? {v}3(?: 0)?
osl-2.1 | open software | open software {L}(?: osl)? {v}2 1
osl-2.0 | open software | open software {L}(?: osl)? {v}2 0
osl-1.0 | open software | open software {L}(?: osl)? {v}1 [01]
osl | open software | open software {L}
afl-3.0 | academic free | academic free {L}(?: afl)? {v}3(?: 0)?
afl-2.1 | academic free | academic free {L}(?: afl)? {v}2 1
afl-2.0 | academic free | academic free {L}(?: afl)? {v}2 0
afl | academic free | academic free {L}
bsl-1.0 | boost | distributed under the boost software {L} version 1 0
bsl-1.0 | boost | http www boost org {L} 1 0(?: txt)?
bsl-1.0 | boost | boost software {L}(?: {v}1 0)?
bsl-1.0 | boost | boost {L}
zlib | zlib | zlib libpng {L}(?: with acknowledgement)?
zlib | zlib | zlib {L}
zlib | libpng | libpng {L}(?: {v}2)?
zlib | express or implied | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
ncsa | ncsa | (?:university of illinois )?ncsa open source {L}
ncsa | ncsa | ncsa {L}
ncsa | illinois | university of illinois open source {L}
python-2.0 | python software foundation | python software foundation {L} (?:{v}2|agreement)
python-2.0 | python software foundation | python software foundation {L}
python-2.0 | psf | psf {L}(?: agreement)?
cnri-python | cnri | cnri (?:open source )?(?:gpl compatible )?{L} agreement
php-3.01 | php | php {L} {v}3 01
php-3.0 | php | php {L} {v}3 0
php | php | php {L}
ruby | ruby | (?:under )?the same terms as ruby(?: itself)?
ruby | ruby | ruby s {L}
ruby | ruby | ruby {L}
postgresql | postgresql | postgresql {L}
openssl | openssl | openssl {L}
openssl | openssl | this product includes software developed by the openssl project
ssleay | ssleay | ssleay {L}
ofl-1.1 | open font | this font software is licensed under the sil open font {L} version 1 1
ofl-1.1 | open font | (?:sil )?open font {L} {v}1 1
ofl-1.0 | open font | (?:sil )?open font {L} {v}1 0
ofl | open font | (?:sil )?open font {L}
ofl | ofl | ofl 1 [01]
ufl-1.0 | ubuntu | ubuntu font {L}(?: 1 0)?
odbl-1.0 | odbl | odbl(?: {v}1 0)?
odbl-1.0 | open database | (?:open data commons )?open database {L}(?: odbl)?(?: {v}1 0)?
odc-by-1.0 | open data commons | open data commons attribution {L}(?: {v}1 0)?
pddl-1.0 | open data commons | open data commons public domain dedication(?: and {L})?
pddl-1.0 | pddl | pddl(?: 1 0)?
cdla-permissive | community data | community data {L} agreement permissive(?: version [12] 0| [12] 0)?
cdla-sharing | community data | community data {L} agreement sharing(?: version 1 0| 1 0)?
ogl-uk | open government | open government {L}(?: {v}[123](?: 0)?)?
wtfpl | wtfpl | wtfpl(?: {v}2)?
wtfpl | do what the | do what the fuck you want to public {L}(?: version 2)?
unlicense | unlicense | (?:the )?unlicense
unlicense | unencumbered | this is free and unencumbered software released into the public domain
cecill-2.1 | cecill | cecill(?: free software {L} agreement)? {v}2 1
cecill-2.0 | cecill | cecill(?: free software {L} agreement)? {v}2(?: 0)?
cecill-b | cecill | cecill b(?: {L})?
cecill-c | cecill | cecill c(?: {L})?
cecill | cecill | cecill(?: {L})?
eupl-1.2 | european union public | european union public {L}(?: eupl)? {v}1 2
eupl-1.1 | european union public | european union public {L}(?: eupl)? {v}1 1
eupl | european union public | european union public {L}
eupl | eupl | eupl(?: {v}1 [012])?
vim | vim | vim {L}
ecl-2.0 | educational community | educational community {L}(?: {v}2 0)
ecl-1.0 | educational community | educational community {L}(?: {v}1 0)?
rpl-1.5 | reciprocal public | reciprocal public {L}(?: {v}1 5)
rpl-1.1 | reciprocal public | reciprocal public {L}(?: {v}1 1)?
upl-1.0 | universal permissive | universal permissive {L}(?: upl)?(?: {v}1 0)?
qpl-1.0 | q public | q public {L}(?: {v}1 0)?
nasa-1.3 | nasa | nasa open source agreement(?: {v}1 3)?
lppl-1.3 | latex | latex project public {L}(?: {v}1 3[abc]?)
lppl | latex | latex project public {L}(?: {v}1 [012])?
lppl | lppl | lppl(?: {v}1 3[abc]?)?
sleepycat | sleepycat | sleepycat {L}
wxwindows | wxwindows | wxwindows(?: library)? {L}(?: {v}3 1)?
zpl-2.1 | zope | zope public {L}(?: zpl)?(?: {v}2 [01])?
w3c | w3c | w3c (?:software|document)(?: notice)?(?: and)?(?: document)? {L}
unicode | unicode | unicode {L}(?: agreement)?(?: data files and software)?
curl | curl | curl {L}
ijg | independent jpeg | independent jpeg group(?: s)? {L}
libtiff | libtiff | libtiff {L}
ftl | freetype | freetype(?: project)? {L}
imagemagick | imagemagick | imagemagick {L}
tcl | tcl | tcl tk {L}
naist | naist | naist {L}
bittorrent | bittorrent | bittorrent open source {L}(?: {v}1 [01])?
apsl-2.0 | apple public source | apple public source {L}(?: {v}[12] [012])?
sun-bcl | binary code | sun (?:microsystems )?binary code {L}(?: agreement)?
sissl | sun industry | sun industry standards source {L}
nokia | nokia | nokia open source {L}(?: {v}1 0[a]?)?
intel | intel | intel (?:open source|simplified software) {L}
realnetworks | realnetworks | realnetworks public source {L}(?: {v}1 0)?
sspl-1.0 | server side public | server side public {L}(?: {v}1(?: 0)?)?
busl-1.1 | business source | business source {L}(?: {v}1 1)?
elastic-2.0 | elastic | elastic {L}(?: {v}2 0)?
commons-clause | commons clause | commons clause(?: {L} condition)?(?: {v}1 0)?
polyform-nc | polyform | polyform noncommercial {L}(?: 1 0 0)?
polyform-sb | polyform | polyform small business {L}(?: 1 0 0)?
openrail | openrail | (?:bigscience |creativeml )?openrail(?: m)?(?: {L})?
openrail | rail | (?:bigscience |creativeml open )rail(?: m)?(?: {L})?
llama | llama | llama [23](?: [123])? community {L}(?: agreement)?
gemma | gemma | gemma terms of use
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?
cc-by-nc | creative commons | creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?
cc-by-sa | creative commons | creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?
cc-by-nd | creative commons | creative commons attribution no ?deriv(?:s|atives|ative works)(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?
cc-by | creative commons | creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: {L})?
cc0-1.0 | creative commons | creative commons (?:zero|cc0)(?: {v}1 0)?(?: universal)?
cc | creative commons | (?:under|with) a creative commons {L}
cc-by-nc-sa | creativecommons | (?:https?|www) creativecommons org licenses by nc sa(?: [1234] [05])?
cc-by-nc-nd | creativecommons | (?:https?|www) creativecommons org licenses by nc nd(?: [1234] [05])?
cc-by-nc | creativecommons | (?:https?|www) creativecommons org licenses by nc(?: [1234] [05])?
cc-by-sa | creativecommons | (?:https?|www) creativecommons org licenses by sa(?: [1234] [05])?
cc-by-nd | creativecommons | (?:https?|www) creativecommons org licenses by nd(?: [1234] [05])?
cc-by | creativecommons | (?:https?|www) creativecommons org licenses by(?: [1234] [05])?
cc0-1.0 | creativecommons | (?:https?|www) creativecommons org publicdomain zero 1 0
cc-by-nc-sa | cc | cc by nc sa(?: [1234] [05])?
cc-by-nc-nd | cc | cc by nc nd(?: [1234] [05])?
cc-by-nc | cc | cc by nc(?: [1234] [05])?
cc-by-sa | cc | cc by sa(?: [1234] [05])?
cc-by-nd | cc | cc by nd(?: [1234] [05])?
cc-by | cc | cc by(?: [1234] [05])
cc-by | cc | (?:licensed|released|published|available|content) under (?:a )?cc by
cc0-1.0 | cc0 | cc0(?: {v}1 0)?(?: universal)?
public-domain | public domain | (?:released|placed|dedicated|donated|put) (?:in|into|to) the public domain
public-domain | public domain | (?:this (?:work|file|code|software) is )(?:hereby )?in the public domain
public-domain | public domain | public domain dedication
free-restricted | non commercial use | (?:free )?for non commercial use only
free-restricted | noncommercial use | (?:free )?for noncommercial use only
proprietary | confidential | (?:proprietary and confidential|confidential and proprietary)
proprietary | confidential | this (?:document|software|file) contains confidential(?: and proprietary)? information
proprietary | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
proprietary | all rights reserved | copyright c? ?[12][0-9]{3}(?: [^ ]+){1,5} all rights reserved
proprietary | all rights reserved | all rights reserved
proprietary | end user | end user {L} agreement
proprietary | commercial | (?:under|requires) (?:a |the )?commercial {L}
"""


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern) of every line; 0 comes first."""
    out = []
    for line in RULES.strip().split("\n"):
        label, keyword, pattern = (x.strip() for x in line.split(" | "))
        for name, part in PARTS.items():
            pattern = pattern.replace(name, part)
        out.append((len(out), label, keyword, pattern))
    return out
