"""Notices and characteristic passages of licences, by family, and sentences that only sound like one.

Fixed values: public licence wording.
"""

TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v2.0 or later.",
        "Released under the GNU GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the terms of the GNU AGPL version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Company. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior "
        "written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying of this file is strictly prohibited.",
    ],
}

#: No licences, though they share words with some.
OTHERS = [
    "The city council approved a licence for the new restaurant on Monday.",
    "He lost his driver's license after the third offence.",
    "The general public is invited to the opening.",
    "The studio licensed the film to a foreign network for two years.",
    "Version 2.0 of the game was released in March.",
    "A copy of the report is available free of charge at the office.",
    "The foundation gave free software courses to schools.",
    "Source code and binary files are kept on separate disks.",
    "The work was published under a false name.",
    "She studied at MIT before she joined the company.",
    "The Apache helicopter was released to the museum.",
    "The terms of the agreement were not disclosed to the public.",
    "Rights of the workers were discussed at length.",
    "The permission to build was granted by the city.",
    "Copyright law has changed in the last ten years.",
    "",
]
