"""Signature rules for licences: one a line, as `priority label | keyword | pattern`.

Texts are words in lower case, one blank apart, so "CC BY-SA 4.0" reads `cc by sa 4 0`. A pattern stands for whole words;
`~` is a gap of up to six words. The keyword, a part of every match, gates the pattern. Higher priority comes first: full
texts and tags (90), notices (70), names with version (60), names (40), hints (20).
"""

RULES = """
90 mit | obtaining a copy | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
85 mit | without limitation the rights to use | without limitation the rights to use copy modify merge publish distribute sublicense
90 mit | identifier mit | spdx license identifier mit
85 mit-0 | identifier mit 0 | spdx license identifier mit 0
70 mit | mit | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit(?: license| licence)?
60 mit | mit licen | mit (?:license|licence)
60 mit | expat licen | expat (?:license|licence)
60 x11 | x11 licen | x11 (?:license|licence)
90 x11 | name of the x consortium | except as contained in this notice the name of the x consortium
90 isc | permission to use copy modify and | permission to use copy modify and or distribute this software for any purpose with or without fee
90 isc | identifier isc | spdx license identifier isc
60 isc | isc licen | isc (?:license|licence)
90 apache-2.0 | apache license version 2 0 | licensed under the apache license version 2 0
90 apache-2.0 | licenses license 2 0 | apache org licenses license 2 0
90 apache-2.0 | identifier apache 2 0 | spdx license identifier apache 2 0
85 apache-2.0 | grant of patent license | grant of patent license subject to the terms and conditions
60 apache-2.0 | apache | apache (?:software )?(?:license|licence|public license)(?: version| v)? ?2(?: 0)?
60 apache-2.0 | apache 2 0 | apache 2 0
60 apache-2.0 | asl 2 0 | asl 2 0
60 apache-1.1 | apache software license version 1 1 | apache software license version 1 1
60 apache-1.0 | apache license version 1 0 | apache license version 1 0
40 apache | apache licen | apache (?:license|licence)
40 apache | apache software licen | apache software (?:license|licence)
90 bsd-2-clause | identifier bsd 2 clause | spdx license identifier bsd 2 clause
90 bsd-3-clause | identifier bsd 3 clause | spdx license identifier bsd 3 clause
85 bsd-3-clause | endorse or promote products | neither the name of ~ nor the names of its contributors may be used to endorse or promote products
80 bsd | redistribution and use in source and binary | redistribution and use in source and binary forms with or without modification are permitted
85 bsd-4-clause | all advertising materials mentioning | all advertising materials mentioning features or use of this software must display
60 bsd-2-clause | bsd | (?:2|two) clause bsd|bsd 2 clause|simplified bsd|freebsd license
60 bsd-3-clause | bsd | (?:3|three) clause bsd|bsd 3 clause|(?:new|modified|revised) bsd
60 bsd-4-clause | bsd | (?:4|four) clause bsd|bsd 4 clause|original bsd license
60 0bsd | bsd | 0bsd|zero clause bsd|bsd zero clause
40 bsd | bsd licen | bsd (?:license|licence|licensed)
40 bsd | bsd style | bsd style (?:license|licence|licensed)
90 gpl-2.0 | identifier gpl 2 0 | spdx license identifier gpl 2 0(?: only)?
91 gpl-2.0-or-later | identifier gpl 2 0 or later | spdx license identifier gpl 2 0 or later
90 gpl-3.0 | identifier gpl 3 0 | spdx license identifier gpl 3 0(?: only)?
91 gpl-3.0-or-later | identifier gpl 3 0 or later | spdx license identifier gpl 3 0 or later
85 gpl-2.0-or-later | either version 2 | gnu general public license(?: as published by the free software foundation)? ~ either version 2 (?:of the license or|or at your option any later)
85 gpl-3.0-or-later | either version 3 | gnu general public license(?: as published by the free software foundation)? ~ either version 3 (?:of the license or|or at your option any later)
75 gpl-2.0 | version 2 | (?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? version 2
75 gpl-3.0 | version 3 | (?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? version 3
75 gpl-2.0 | general public license v2 | (?:gnu )?general public license v2
75 gpl-3.0 | general public license v3 | (?:gnu )?general public license v3
75 gpl-1.0 | version 1 | (?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? version 1
80 gpl | you can redistribute it | you can redistribute it and or modify it under the terms of the gnu general public license
65 gpl-2.0-or-later | or later | gpl ?(?:version |v )?v?2(?: 0)? or later
65 gpl-3.0-or-later | or later | gpl ?(?:version |v )?v?3(?: 0)? or later
60 gpl-2.0 | gpl | gpl(?: version| v)? ?v?2(?: 0)?
60 gpl-3.0 | gpl | gpl(?: version| v)? ?v?3(?: 0)?
60 gpl-2.0 | gplv2 | gplv2
60 gpl-3.0 | gplv3 | gplv3
70 gpl | gpl | (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?gpl
40 gpl | gnu gpl | gnu gpl
40 gpl | gnu general public | gnu general public (?:license|licence)
66 gpl-classpath | classpath exception | classpath exception
66 gpl-font | font exception | gpl ~ font exception
90 lgpl-2.1 | identifier lgpl 2 1 | spdx license identifier lgpl 2 1(?: only| or later)?
90 lgpl-3.0 | identifier lgpl 3 0 | spdx license identifier lgpl 3 0(?: only| or later)?
90 lgpl-2.0 | identifier lgpl 2 0 | spdx license identifier lgpl 2 0(?: only| or later)?
80 lgpl-2.1 | lesser general public license | (?:gnu )?lesser general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)2 1
80 lgpl-3.0 | lesser general public license | (?:gnu )?lesser general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)3
80 lgpl-2.0 | lesser general public license | (?:gnu )?lesser general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)2
80 lgpl-2.0 | library general public license | (?:gnu )?library general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2
76 lgpl | lesser general public | (?:gnu )?lesser general public (?:license|licence)
76 lgpl | library general public | (?:gnu )?library general public (?:license|licence)
62 lgpl-2.1 | lgpl | lgpl(?: version| v)? ?v?2 1
62 lgpl-3.0 | lgpl | lgpl(?: version| v)? ?v?3(?: 0)?
62 lgpl-2.1 | lgplv2 1 | lgplv2 1
62 lgpl-3.0 | lgplv3 | lgplv3
40 lgpl | lgpl | (?:gnu )?lgpl
90 agpl-3.0 | identifier agpl 3 0 | spdx license identifier agpl 3 0(?: only| or later)?
80 agpl-3.0 | affero general public license | (?:gnu )?affero general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)3
76 agpl | affero general public | (?:gnu )?affero general public (?:license|licence)
62 agpl-3.0 | agpl | agpl(?: version| v)? ?v?3(?: 0)?
62 agpl-3.0 | agplv3 | agplv3
40 agpl | agpl | (?:gnu )?agpl
80 gfdl-1.3 | free documentation license | (?:gnu )?free documentation license version 1 3
80 gfdl-1.2 | free documentation license | (?:gnu )?free documentation license version 1 2
60 gfdl | free documentation licen | (?:gnu )?free documentation (?:license|licence)
40 gfdl | gfdl | (?:gnu )?gfdl
90 mpl-2.0 | identifier mpl 2 0 | spdx license identifier mpl 2 0
90 mpl-2.0 | mozilla public license | subject to the terms of the mozilla public license v 2 0
90 mpl-1.1 | mozilla public license | subject to the mozilla public license version 1 1
62 mpl-2.0 | mozilla public licen | mozilla public (?:license|licence)(?: version| v)? 2(?: 0)?
62 mpl-1.1 | mozilla public licen | mozilla public (?:license|licence)(?: version| v)? 1 1
60 mpl | mozilla public licen | mozilla public (?:license|licence)
50 mpl-2.0 | mpl 2 0 | mpl 2 0
50 mpl-1.1 | mpl 1 1 | mpl 1 1
90 epl-2.0 | identifier epl 2 0 | spdx license identifier epl 2 0
90 epl-1.0 | identifier epl 1 0 | spdx license identifier epl 1 0
62 epl-2.0 | eclipse public licen | eclipse public (?:license|licence)(?: version| v)? 2(?: 0)?
62 epl-1.0 | eclipse public licen | eclipse public (?:license|licence)(?: version| v)? 1(?: 0)?
60 epl | eclipse public licen | eclipse public (?:license|licence)
62 edl-1.0 | eclipse distribution licen | eclipse distribution (?:license|licence)(?: version| v)? 1 0
62 cddl-1.1 | common development and distribution | common development and distribution (?:license|licence)(?: version| v)? 1 1
62 cddl-1.0 | common development and distribution | common development and distribution (?:license|licence)(?: version| v)? 1 0
60 cddl | common development and distribution | common development and distribution (?:license|licence)
40 cddl | cddl | cddl
62 cpl-1.0 | common public licen | common public (?:license|licence)(?: version| v)? 1 0
60 cpl | common public licen | common public (?:license|licence)
62 cpal-1.0 | common public attribution | common public attribution (?:license|licence)
62 ipl-1.0 | ibm public licen | ibm public (?:license|licence)
62 artistic-2.0 | artistic licen | artistic (?:license|licence) 2 0
62 artistic-1.0 | artistic licen | artistic (?:license|licence) 1 0
60 artistic | artistic licen | artistic (?:license|licence)
60 perl | same terms as perl | under the same terms as perl(?: itself)?
62 zlib | zlib licen | zlib (?:license|licence)
62 zlib | zlib libpng licen | zlib libpng (?:license|licence)
90 zlib | provided as is without any express | this software is provided as is without any express or implied warranty in no event will the authors be held liable
62 libpng | libpng licen | libpng (?:license|licence)
62 bsl-1.0 | boost software licen | boost software (?:license|licence)(?: version| v)?(?: 1 0)?
62 busl-1.1 | business source licen | business source (?:license|licence)(?: 1 1)?
62 sspl-1.0 | server side public licen | server side public (?:license|licence)
62 elastic-2.0 | elastic licen | elastic (?:license|licence)(?: v?2(?: 0)?)?
62 commons-clause | commons clause | commons clause
62 confluent | confluent community licen | confluent community (?:license|licence)
62 polyform-nc | polyform noncommercial | polyform noncommercial (?:license|licence)
62 polyform-shield | polyform shield | polyform shield (?:license|licence)
62 redis | redis source available | redis source available (?:license|licence)
62 timescale | timescale licen | timescale (?:license|licence)
90 unlicense | released into the public domain | this is free and unencumbered software released into the public domain
60 unlicense | unlicense | the unlicense|unlicense
60 wtfpl | wtfpl | wtfpl
60 wtfpl | what the fuck you want | do what the fuck you want to public license
60 beerware | beer | beer ?ware (?:license|licence)|buy me a beer in return
60 json | software shall be used for good | the software shall be used for good not evil
60 openssl | openssl licen | openssl (?:license|licence)
60 ssleay | ssleay licen | (?:original )?ssleay (?:license|licence)
60 openldap | openldap public licen | openldap public (?:license|licence)
60 postgresql | postgresql licen | postgresql (?:license|licence)
60 php-3.01 | php licen | php (?:license|licence)(?: version)? 3 01
50 php | php licen | php (?:license|licence)
60 python-2.0 | python software foundation licen | python software foundation (?:license|licence)
50 psf | psf licen | psf (?:license|licence)
60 ruby | ruby licen | ruby (?:license|licence)
60 ruby | ruby s licen | ruby s (?:license|licence)
60 zpl-2.1 | zope public licen | zope public (?:license|licence)(?: version)? 2 1
50 zpl | zope public licen | zope public (?:license|licence)
60 w3c | w3c software | w3c software (?:notice and )?(?:document )?(?:license|licence)
60 ncsa | ncsa open source | (?:university of illinois )?ncsa open source (?:license|licence)
60 upl-1.0 | universal permissive licen | universal permissive (?:license|licence)
60 eupl-1.2 | european union public licen | european union public (?:license|licence)(?: version| v)? 1 2
58 eupl | european union public licen | european union public (?:license|licence)
40 eupl | eupl | eupl
60 cecill-2.1 | cecill | cecill(?: version| v)? 2 1
50 cecill-b | cecill b | cecill b
50 cecill-c | cecill c | cecill c
40 cecill | cecill | cecill
60 osl-3.0 | open software licen | open software (?:license|licence)(?: version| v)? 3 0
50 osl | open software licen | open software (?:license|licence)
60 afl-3.0 | academic free licen | academic free (?:license|licence)(?: version| v)? 3 0
50 afl | academic free licen | academic free (?:license|licence)
60 ms-pl | microsoft public licen | microsoft public (?:license|licence)
60 ms-rl | microsoft reciprocal | microsoft reciprocal (?:license|licence)
60 ofl-1.1 | sil open font licen | sil open font (?:license|licence)(?: version| v)? 1 1
50 ofl | open font licen | (?:sil )?open font (?:license|licence)
60 vim | vim licen | vim (?:license|licence)
60 tcl | tcl tk licen | tcl tk (?:license|licence)
60 sleepycat | sleepycat licen | sleepycat (?:license|licence)
60 qpl-1.0 | q public licen | q public (?:license|licence)
60 rpl-1.5 | reciprocal public licen | reciprocal public (?:license|licence)
60 nposl-3.0 | non profit open software | non profit open software (?:license|licence)
60 mulan-2.0 | mulan psl | mulan psl(?: v2| 2 0)?
60 bluetree | blue oak model | blue oak model (?:license|licence)
60 curl | curl licen | curl (?:license|licence)
60 ijg | independent jpeg group | independent jpeg group (?:license|licence)
60 imagemagick | imagemagick licen | imagemagick (?:license|licence)
60 unicode | unicode licen | unicode (?:license|licence)
60 unicode | unicode inc licen | unicode inc (?:license|licence)
60 icu | icu licen | icu (?:license|licence)
60 hpnd | historical permission notice | historical permission notice and disclaimer
60 ecl-2.0 | educational community licen | educational community (?:license|licence)
60 lppl | latex project public licen | (?:latex project public (?:license|licence))
60 openrail | openrail | (?:creativeml )?(?:big ?science )?(?:bigcode )?openrail(?: m| s)?
60 llama | llama | llama (?:2|3|3 1|3 2|3 3|4)? ?community (?:license|licence)
60 gemma | gemma terms of use | gemma terms of use
60 rail | responsible ai licen | responsible ai (?:license|licence)s?
95 cc-by-nc-nd-4.0 | licenses by nc nd 4 0 | creativecommons org licenses by nc nd 4 0
95 cc-by-nc-sa-4.0 | licenses by nc sa 4 0 | creativecommons org licenses by nc sa 4 0
95 cc-by-nc-4.0 | licenses by nc 4 0 | creativecommons org licenses by nc 4 0
95 cc-by-nd-4.0 | licenses by nd 4 0 | creativecommons org licenses by nd 4 0
95 cc-by-sa-4.0 | licenses by sa 4 0 | creativecommons org licenses by sa 4 0
95 cc-by-4.0 | licenses by 4 0 | creativecommons org licenses by 4 0
95 cc-by-sa-3.0 | licenses by sa 3 0 | creativecommons org licenses by sa 3 0
95 cc-by-3.0 | licenses by 3 0 | creativecommons org licenses by 3 0
95 cc-by-nc-sa-3.0 | licenses by nc sa 3 0 | creativecommons org licenses by nc sa 3 0
95 cc0-1.0 | publicdomain zero 1 0 | creativecommons org publicdomain zero 1 0
75 cc-by-nc-nd-4.0 | cc by nc nd | cc by nc nd 4 0
74 cc-by-nc-nd-3.0 | cc by nc nd | cc by nc nd 3 0
73 cc-by-nc-nd | cc by nc nd | cc by nc nd
75 cc-by-nc-sa-4.0 | cc by nc sa | cc by nc sa 4 0
74 cc-by-nc-sa-3.0 | cc by nc sa | cc by nc sa 3 0
73 cc-by-nc-sa | cc by nc sa | cc by nc sa
72 cc-by-nc-4.0 | cc by nc | cc by nc 4 0
71 cc-by-nc-3.0 | cc by nc | cc by nc 3 0
70 cc-by-nc | cc by nc | cc by nc
72 cc-by-nd-4.0 | cc by nd | cc by nd 4 0
71 cc-by-nd-3.0 | cc by nd | cc by nd 3 0
70 cc-by-nd | cc by nd | cc by nd
72 cc-by-sa-4.0 | cc by sa | cc by sa 4 0
71 cc-by-sa-3.0 | cc by sa | cc by sa 3 0
71 cc-by-sa-2.5 | cc by sa | cc by sa 2 5
71 cc-by-sa-2.0 | cc by sa | cc by sa 2 0
70 cc-by-sa | cc by sa | cc by sa
62 cc-by-4.0 | cc by 4 0 | cc by 4 0
62 cc-by-3.0 | cc by 3 0 | cc by 3 0
62 cc-by-2.5 | cc by 2 5 | cc by 2 5
62 cc-by-2.0 | cc by 2 0 | cc by 2 0
60 cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
60 cc0-1.0 | cc zero | cc zero
80 cc-by-nc-nd | attribution noncommercial noderiv | (?:creative commons )?attribution noncommercial noderiv(?:ative)?s?
80 cc-by-nc-nd | attribution non commercial no deriv | (?:creative commons )?attribution non commercial no deriv(?:ative)?s?
80 cc-by-nc-sa | attribution noncommercial sharealike | (?:creative commons )?attribution noncommercial sharealike
80 cc-by-nc-sa | attribution non commercial share alike | (?:creative commons )?attribution non commercial share alike
78 cc-by-nc | creative commons attribution noncommercial | creative commons attribution noncommercial
78 cc-by-nc | creative commons attribution non commercial | creative commons attribution non commercial
78 cc-by-sa | creative commons attribution share | creative commons attribution share ?alike
78 cc-by-nd | creative commons attribution no | creative commons attribution no ?deriv(?:ative)?s?
68 cc-by-4.0 | creative commons attribution | creative commons attribution (?:license |licence )?(?:version )?4 0
68 cc-by-3.0 | creative commons attribution | creative commons attribution (?:license |licence )?(?:version )?3 0
66 cc-by | creative commons attribution | creative commons attribution(?: license| licence)?
30 creative-commons | creative commons | creative commons(?: license| licence| licensed)?
62 odbl-1.0 | open database licen | open database (?:license|licence)
62 odc-by-1.0 | open data commons attribution | open data commons attribution (?:license|licence)
62 pddl-1.0 | public domain dedication | (?:open data commons )?public domain dedication (?:and )?(?:license|licence)
50 odbl-1.0 | odbl | odbl
62 ogl-uk-3.0 | open government licen | open government (?:license|licence)(?: version| v)? ?v?3(?: 0)?
58 ogl | open government licen | open government (?:license|licence)
60 etalab-2.0 | etalab | (?:licence ouverte )?etalab(?: 2 0)?
60 licence-ouverte | licence ouverte | licence ouverte
60 dl-de-by-2.0 | datenlizenz deutschland | datenlizenz deutschland(?: namensnennung)?(?: 2 0)?
60 cdla-permissive | community data licen | community data (?:license|licence) agreement permissive
60 cdla-sharing | community data licen | community data (?:license|licence) agreement sharing
60 freeart | free art licen | free art (?:license|licence)
60 dsl | design science licen | design science (?:license|licence)
50 public-domain | public domain | (?:placed in|released into|released to|in|dedicated to) the public domain
30 public-domain | public domain | public domain
50 public-domain | us government work | (?:this is a )?us government work
50 public-domain | u s government work | (?:this is a )?u s government work
66 proprietary | strictly prohibited | unauthori[sz]ed (?:copying|use|reproduction|distribution) ~ strictly prohibited
66 proprietary | proprietary and confidential | proprietary and confidential
60 proprietary | proprietary licen | proprietary (?:license|licence)
60 proprietary | proprietary software | proprietary software
60 proprietary | may not be reproduced | may not be reproduced(?: or transmitted| distributed| copied)? ~ without ~ permission
60 proprietary | no part of this publication | no part of this publication may be reproduced
60 eula | end user licen | end user (?:license|licence) agreement
50 shareware | shareware | shareware
50 freeware | freeware | freeware
50 noncommercial | commercial use | (?:for )?non ?commercial use only|not for commercial use
50 noncommercial | noncommercial | noncommercial purposes only
50 research-only | research | for research (?:use|purposes) only|research only license
50 reserved-de | alle rechte vorbehalten | alle rechte vorbehalten
50 reserved-fr | tous droits r | tous droits réservés
50 reserved-es | todos los derechos reservados | todos los derechos reservados
50 reserved-it | tutti i diritti riservati | tutti i diritti riservati
50 reserved-pt | todos os direitos reservados | todos os direitos reservados
40 reserved | some rights reserved | some rights reserved
40 copyright | copyright | copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
40 copyright | copyright | (?:19|20)[0-9][0-9] ~ copyright holders?
30 terms-of-service | terms of service | terms of service
30 terms-of-service | terms of use | terms of use
20 copyleft | copyleft | copyleft
20 open-source | open source licen | open source (?:license|licence|licensed)
20 dual | dual licen | dual (?:license|licence)[ds]?
20 dual | dually licensed | dually licensed
20 see-file | see the license file | see the license file
20 see-file | see the licence file | see the licence file
20 see-file | see the copying file | see the copying file
20 see-file | see license | see license (?:txt|md|file)
"""
