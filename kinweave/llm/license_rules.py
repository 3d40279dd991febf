"""Signature rules of licences: one rule a line, written by hand.

A line is ``label | weight | keyword | expression``. A rule is tried only on texts that hold its
keyword; expressions see the text with A-Z lowered. Lines stand in order of priority, the
strongest first: notices and grants, then SPDX tags, addresses, titles, and at last short names.
"""

NOTICES = r"""
apache-2.0 | 0.99 | apache license | licensed under the apache license,?\s+version 2(?:\.0)?
apache-2.0 | 0.98 | apache license | under the terms of the apache license,?\s+version 2(?:\.0)?
apache-2.0 | 0.97 | apache license | you may not use this file except in compliance with the license
apache-1.1 | 0.97 | apache software license | apache software license,?\s+version 1\.1
apache-1.0 | 0.95 | apache group | this product includes software developed by the apache group
apache | 0.85 | apache license | (?:released|distributed|available|licensed) under the apache license
mit | 0.99 | permission is hereby granted | permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | 0.97 | mit license | (?:released|distributed|available|published|licensed) under the (?:terms of the )?mit license
mit | 0.94 | mit licence | (?:released|distributed|available|published|licensed) under the (?:terms of the )?mit licence
mit-0 | 0.97 | mit no attribution | mit no attribution(?: license)?
x11 | 0.95 | x consortium | except as contained in this notice, the name of the x consortium
isc | 0.97 | permission to use | permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee
isc | 0.95 | isc license | (?:released|distributed|available|licensed) under the isc license
bsd-4-clause | 0.97 | all advertising materials | all advertising materials mentioning features or use of this software must display
bsd-3-clause | 0.97 | neither the name | neither the names? of .{1,120}? nor the names of its contributors may be used
bsd-2-clause | 0.93 | redistributions | redistributions in binary form must reproduce the above copyright notice
bsd-2-clause | 0.9 | redistributions | redistributions of source code must retain the above copyright notice
bsd | 0.9 | bsd license | (?:released|distributed|available|licensed) under (?:the|a) bsd license
bsd | 0.88 | bsd-style | (?:released|governed|distributed|licensed) (?:under|by) a bsd-style licen[sc]e
gpl-2.0-or-later | 0.99 | general public license | either version 2 of the license, or \(at your option\) any later version
gpl-3.0-or-later | 0.99 | general public license | either version 3 of the license, or \(at your option\) any later version
agpl-3.0-or-later | 0.99 | affero general public license | gnu affero general public license.{0,120}?either version 3 of the license, or
lgpl-2.1-or-later | 0.99 | general public license | either version 2\.1 of the license, or \(at your option\) any later version
gpl-3.0 | 0.99 | general public license | licensed under the gnu general public license,?\s+version 3
gpl-2.0 | 0.99 | general public license | licensed under the gnu general public license,?\s+version 2
gpl-3.0 | 0.95 | general public license | under the terms of (?:the )?gnu general public license,?\s+version 3
gpl-2.0 | 0.95 | general public license | under the terms of (?:the )?gnu general public license,?\s+version 2
gpl | 0.93 | general public license | under the terms of the gnu general public license
lgpl-3.0 | 0.97 | lesser general public license | licensed under the gnu lesser general public license,?\s+version 3
lgpl-2.1 | 0.97 | lesser general public license | licensed under the gnu lesser general public license,?\s+version 2\.1
lgpl | 0.93 | lesser general public license | under the terms of the gnu lesser general public license
lgpl-2.0 | 0.93 | library general public license | under the terms of the gnu library general public license
agpl-3.0 | 0.97 | affero general public license | licensed under the gnu affero general public license,?\s+version 3
agpl | 0.93 | affero general public license | under the terms of the gnu affero general public license
gfdl | 0.95 | free documentation license | under the terms of the gnu free documentation license
gfdl-1.3 | 0.97 | free documentation license | gnu free documentation license,?\s+version 1\.3
gfdl-1.2 | 0.97 | free documentation license | gnu free documentation license,?\s+version 1\.2
gfdl-1.1 | 0.97 | free documentation license | gnu free documentation license,?\s+version 1\.1
mpl-2.0 | 0.99 | mozilla public license | subject to the terms of the mozilla public license,?\s+v(?:ersion |\. ?)2\.0
mpl-1.1 | 0.99 | mozilla public license | subject to the mozilla public license version 1\.1
mpl-1.0 | 0.97 | mozilla public license | subject to the mozilla public license version 1\.0
epl-2.0 | 0.97 | eclipse public license | under the terms of the eclipse public license,? (?:v|version )?2\.0
epl-1.0 | 0.97 | eclipse public license | under the terms of the eclipse public license,? (?:v|version )?1\.0
edl-1.0 | 0.95 | eclipse distribution license | eclipse distribution license,? (?:v|version )?1\.0
cddl-1.1 | 0.97 | common development and distribution | common development and distribution license.{0,20}?1\.1
cddl-1.0 | 0.95 | common development and distribution | common development and distribution license
eupl-1.2 | 0.97 | european union public | european union public licen[sc]e.{0,20}?1\.2
eupl-1.1 | 0.97 | european union public | european union public licen[sc]e.{0,20}?1\.1
eupl | 0.9 | european union public | european union public licen[sc]e
unlicense | 0.97 | public domain | this is free and unencumbered software released into the public domain
cc0-1.0 | 0.97 | waived all copyright | waived all copyright and related or neighbou?ring rights
public-domain | 0.93 | public domain | (?:dedicated to|released into|placed in) the public domain
public-domain | 0.85 | public domain | (?:this|the) (?:work|file|code|text|image) is in the public domain
zlib | 0.97 | as-is | this software is provided 'as-is', without any express or implied warranty
bsl-1.0 | 0.97 | boost software license | (?:distributed|licensed) under the boost software license,?\s+version 1\.0
wtfpl | 0.97 | what the fuck | do what the fuck you want to public license
artistic-2.0 | 0.95 | artistic license | artistic license,?\s*(?:version )?2\.0
artistic-1.0 | 0.93 | artistic license | artistic license,?\s*(?:version )?1\.0
perl | 0.93 | same terms as perl | under the same terms as perl(?: itself)?
ofl-1.1 | 0.97 | open font license | licensed under the sil open font license,?\s+version 1\.1
odbl-1.0 | 0.95 | open database license | open database license.{0,12}?(?:v|version )?1\.0
odc-by-1.0 | 0.95 | open data commons | open data commons attribution license
pddl-1.0 | 0.95 | open data commons | open data commons public domain dedication
ogl-uk-3.0 | 0.95 | open government licence | open government licence.{0,10}?v?3\.0
ogl-uk | 0.9 | open government licence | under the open government licence
cc-by-nc-nd | 0.97 | cc by-nc-nd | licensed under (?:a )?cc by-nc-nd(?: [1-4]\.0)?
cc-by-nc-sa | 0.97 | cc by-nc-sa | licensed under (?:a )?cc by-nc-sa(?: [1-4]\.0)?
cc-by-nc | 0.97 | cc by-nc | licensed under (?:a )?cc by-nc(?: [1-4]\.0)?(?!-)
cc-by-nd | 0.97 | cc by-nd | licensed under (?:a )?cc by-nd(?: [1-4]\.0)?
cc-by-sa | 0.97 | cc by-sa | licensed under (?:a )?cc by-sa(?: [1-4]\.0)?
cc-by | 0.97 | cc by | licensed under (?:a )?cc by(?: [1-4]\.0)?(?!-)
cc-by-nc-nd | 0.97 | creative commons | creative commons attribution[ -]non-?commercial[ -]no-?deriv(?:ative|s|atives)
cc-by-nc-sa | 0.97 | creative commons | creative commons attribution[ -]non-?commercial[ -]share[ -]?alike
cc-by-nc | 0.96 | creative commons | creative commons attribution[ -]non-?commercial(?![ -](?:share|no))
cc-by-nd | 0.96 | creative commons | creative commons attribution[ -]no-?deriv(?:ative|s|atives)
cc-by-sa | 0.96 | creative commons | creative commons attribution[ -]share[ -]?alike
cc-by | 0.95 | creative commons | creative commons attribution(?: [1-4]\.0)?(?! ?-? ?(?:non|no|share))
ms-pl | 0.95 | microsoft public license | microsoft public license
ms-rl | 0.95 | microsoft reciprocal license | microsoft reciprocal license
python-2.0 | 0.95 | python software foundation license | python software foundation license
ruby | 0.9 | ruby license | (?:under|terms of) the ruby license
php-3.01 | 0.95 | php license | (?:subject to|under) (?:version 3\.01 of )?the php license
openssl | 0.95 | openssl | developed by the openssl project for use in the openssl toolkit
ssleay | 0.95 | eric young | cryptographic software written by eric young
vim | 0.93 | vim license | (?:under|terms of) the vim license
curl | 0.93 | curl license | (?:under|terms of) the curl license
postgresql | 0.95 | postgresql licen | (?:under|terms of) the postgresql licen[sc]e
w3c | 0.95 | w3c | w3c software (?:notice and|and document) (?:license|notice)
unicode | 0.95 | unicode, inc | unicode, inc\. license agreement
ncsa | 0.95 | university of illinois | university of illinois/ncsa open source license
ecl-2.0 | 0.95 | educational community license | educational community license,?\s+version 2\.0
afl-3.0 | 0.95 | academic free license | academic free license.{0,10}?3\.0
osl-3.0 | 0.95 | open software license | open software license.{0,10}?3\.0
qpl-1.0 | 0.93 | q public license | q public license
sleepycat | 0.93 | sleepycat | sleepycat (?:software )?license
watcom | 0.9 | sybase open watcom | sybase open watcom public license
ipl-1.0 | 0.93 | ibm public license | ibm public license
cpl-1.0 | 0.93 | common public license | common public license(?:,? (?:v|version )1\.0)?
apsl-2.0 | 0.93 | apple public source | apple public source license
nasa-1.3 | 0.93 | nasa open source | nasa open source agreement
cecill-2.1 | 0.95 | cecill | cecill(?: free software)? licen[sc]e.{0,20}?2\.1
cecill-b | 0.95 | cecill-b | cecill-b
cecill-c | 0.95 | cecill-c | cecill-c
cecill | 0.9 | cecill | (?:licence|license|under the) cecill
sspl-1.0 | 0.97 | server side public license | server side public license(?:,? (?:v|version )1)?
busl-1.1 | 0.97 | business source license | business source license(?: 1\.1)?
elastic-2.0 | 0.95 | elastic license | elastic license(?: 2\.0)?
commons-clause | 0.95 | commons clause | commons clause(?: license condition)?
polyform | 0.93 | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter) license
rail | 0.93 | responsible ai licen | responsible ai licen[sc]e
rail | 0.93 | openrail | \bopenrail(?:-m)?\b
rail | 0.9 | rail-m | \brail-m\b
hippocratic | 0.93 | hippocratic license | hippocratic license
mulan-psl-2.0 | 0.95 | mulan | mulan (?:psl|permissive software license).{0,6}?2
mulan-psl-1.0 | 0.93 | mulan | mulan (?:psl|permissive software license).{0,6}?1
upl-1.0 | 0.95 | universal permissive license | universal permissive license
blueoak-1.0.0 | 0.95 | blue oak model | blue oak model license
fsl | 0.93 | functional source license | functional source license
proprietary | 0.9 | confidential | (?:proprietary and confidential|confidential and proprietary)
proprietary | 0.9 | unauthori | unauthori[sz]ed (?:copying|use|distribution|reproduction) of this (?:file|document|work|material).{0,40}?prohibited
proprietary | 0.85 | proprietary license | (?:under|subject to) (?:a|the) proprietary license
no-derivatives | 0.8 | derivative works | no derivative works (?:are )?(?:allowed|permitted)
non-commercial | 0.8 | non-commercial | (?:for )?(?:personal and )?non-commercial use only
evaluation | 0.75 | evaluation | licensed for evaluation (?:purposes )?only
reserved | 0.9 | all rights reserved | (?:copyright|\(c\)|©)[^\n]{0,120}?all rights reserved
reserved | 0.8 | rights reserved | some rights reserved
reserved-es | 0.8 | derechos reservados | todos los derechos reservados
reserved-fr | 0.8 | droits r | tous droits r[ée]serv[ée]s
reserved-de | 0.8 | alle rechte vorbehalten | alle rechte vorbehalten
"""

ADDRESSES = r"""
apache-2.0 | 0.9 | apache.org/licenses | apache\.org/licenses/license-2\.0
apache-1.1 | 0.9 | apache.org/licenses | apache\.org/licenses/license-1\.1
mit | 0.9 | opensource.org/licenses | opensource\.org/licenses/mit\b
bsd-3-clause | 0.9 | opensource.org/licenses | opensource\.org/licenses/bsd-3-clause
bsd-2-clause | 0.9 | opensource.org/licenses | opensource\.org/licenses/bsd-2-clause
isc | 0.9 | opensource.org/licenses | opensource\.org/licenses/isc\b
osi | 0.6 | opensource.org/licenses | opensource\.org/licenses/[a-z0-9.-]+
gpl-3.0 | 0.9 | gnu.org/licenses | gnu\.org/licenses/gpl-3\.0
gpl-2.0 | 0.9 | gnu.org/licenses | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl | 0.85 | gnu.org/licenses | gnu\.org/licenses/gpl\b
lgpl-2.1 | 0.9 | gnu.org/licenses | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl-3.0 | 0.9 | gnu.org/licenses | gnu\.org/licenses/lgpl-3\.0
lgpl | 0.85 | gnu.org/licenses | gnu\.org/licenses/lgpl\b
agpl-3.0 | 0.9 | gnu.org/licenses | gnu\.org/licenses/agpl-3\.0
agpl | 0.85 | gnu.org/licenses | gnu\.org/licenses/agpl\b
gfdl | 0.85 | gnu.org/licenses | gnu\.org/(?:licenses|copyleft)/fdl
mpl-2.0 | 0.9 | mozilla.org/mpl | mozilla\.org/(?:en-us/)?mpl/2\.0
mpl-1.1 | 0.9 | mozilla.org/mpl | mozilla\.org/mpl/mpl-1\.1
epl-2.0 | 0.9 | eclipse.org/legal | eclipse\.org/legal/epl-2\.0
epl-1.0 | 0.9 | eclipse.org/legal | eclipse\.org/legal/epl-v10
bsl-1.0 | 0.9 | boost.org/license | boost\.org/license_1_0\.txt
unlicense | 0.9 | unlicense.org | unlicense\.org
wtfpl | 0.9 | wtfpl.net | wtfpl\.net
ofl-1.1 | 0.9 | scripts.sil.org | scripts\.sil\.org/ofl
odbl-1.0 | 0.9 | opendatacommons.org | opendatacommons\.org/licenses/odbl
odc-by-1.0 | 0.9 | opendatacommons.org | opendatacommons\.org/licenses/by
pddl-1.0 | 0.9 | opendatacommons.org | opendatacommons\.org/licenses/pddl
ogl-uk | 0.9 | nationalarchives.gov.uk | nationalarchives\.gov\.uk/doc/open-government-licence
cc0-1.0 | 0.9 | creativecommons.org | creativecommons\.org/publicdomain/zero/1\.0
cc-pdm-1.0 | 0.9 | creativecommons.org | creativecommons\.org/publicdomain/mark/1\.0
cc-by-nc-nd | 0.9 | creativecommons.org | creativecommons\.org/licenses/by-nc-nd
cc-by-nc-sa | 0.9 | creativecommons.org | creativecommons\.org/licenses/by-nc-sa
cc-by-nc | 0.9 | creativecommons.org | creativecommons\.org/licenses/by-nc/
cc-by-nd | 0.9 | creativecommons.org | creativecommons\.org/licenses/by-nd
cc-by-sa | 0.9 | creativecommons.org | creativecommons\.org/licenses/by-sa
cc-by | 0.9 | creativecommons.org | creativecommons\.org/licenses/by/
sspl-1.0 | 0.9 | mongodb.com/licensing | mongodb\.com/licensing/server-side-public-license
cecill | 0.85 | cecill.info | cecill\.info
python-2.0 | 0.85 | python.org | docs\.python\.org/[0-9.]*/?license
blueoak-1.0.0 | 0.9 | blueoakcouncil.org | blueoakcouncil\.org/license/1\.0\.0
"""

TITLES = r"""
apache-2.0 | 0.7 | apache | apache[ -](?:license[ -])?(?:v(?:ersion)? ?)?2(?:\.0)?
apache | 0.55 | apache license | apache license
mit | 0.6 | mit licen | \bmit licen[sc]e\b
expat | 0.6 | expat license | \bexpat license\b
bsd-3-clause | 0.7 | bsd | \b(?:new|modified|revised|3-clause) bsd\b|\bbsd[ -]3[ -]clause
bsd-2-clause | 0.7 | bsd | \b(?:simplified|freebsd|2-clause) bsd\b|\bbsd[ -]2[ -]clause
bsd-4-clause | 0.7 | bsd | \b(?:original|4-clause) bsd\b|\bbsd[ -]4[ -]clause
0bsd | 0.7 | bsd | \bzero[ -]clause bsd\b|\b0bsd\b
bsd | 0.55 | bsd licen | \bbsd licen[sc]e\b
isc | 0.6 | isc licen | \bisc licen[sc]e\b
agpl-3.0 | 0.7 | agpl | \bagpl[ -]?v?3
agpl | 0.6 | agpl | \bagpl\b
lgpl-3.0 | 0.7 | lgpl | \blgpl[ -]?v?3
lgpl-2.1 | 0.7 | lgpl | \blgpl[ -]?v?2\.1
lgpl | 0.6 | lgpl | \blgpl\b
lgpl | 0.6 | lesser general public license | lesser general public license
agpl | 0.6 | affero general public license | affero general public license
gpl-3.0 | 0.7 | gpl | \bgpl[ -]?v?3
gpl-2.0 | 0.7 | gpl | \bgpl[ -]?v?2
gpl-3.0 | 0.75 | general public license | general public license,?\s+version 3
gpl-2.0 | 0.75 | general public license | general public license,?\s+version 2
mpl-2.0 | 0.7 | mozilla public license | mozilla public license.{0,4}?(?:v|version )?2\.0
mpl | 0.6 | mozilla public license | mozilla public license
epl | 0.6 | eclipse public license | eclipse public license
bsl-1.0 | 0.6 | boost software license | boost software license
zlib | 0.6 | zlib license | \bzlib license\b
ofl | 0.6 | open font license | open font license
cc0-1.0 | 0.7 | cc0 | \bcc0\b(?: 1\.0)?
cc-by-nc-nd | 0.7 | by-nc-nd | \bcc[ -]by-nc-nd\b
cc-by-nc-sa | 0.7 | by-nc-sa | \bcc[ -]by-nc-sa\b
cc-by-nc | 0.7 | by-nc | \bcc[ -]by-nc\b(?!-)
cc-by-nd | 0.7 | by-nd | \bcc[ -]by-nd\b
cc-by-sa | 0.7 | by-sa | \bcc[ -]by-sa\b
creative-commons | 0.5 | creative commons | creative commons licen[sc]e
copyleft | 0.4 | copyleft | \bcopyleft\b
copyright | 0.4 | copyright | copyright (?:\(c\) |© )?(?:19|20)[0-9]{2}
copyright | 0.35 | © | © ?(?:19|20)[0-9]{2}
"""

#: Identifiers of the SPDX list (fixed values); each makes one rule for tags and package fields.
SPDX = """
0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0
BlueOak-1.0.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 CAL-1.0 CC-BY-3.0 CC-BY-4.0
CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0
CDDL-1.1 CECILL-2.1 CECILL-B CECILL-C CPL-1.0 curl ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3
GPL-1.0-only GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later HPND ISC LGPL-2.0-only
LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL
MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby
Sleepycat SSPL-1.0 Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1
"""
