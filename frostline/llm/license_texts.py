"""Templates of the license scan: fixed values.

``PHRASES`` are found where their words stand one after another; those of
``BASE_PHRASES`` are the base.  ``NOTICES`` are the customary notices of
licenses, found where enough of their words stand in order.
"""

BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

PHRASES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creative commons zero": "cc0",
    "cc0 1 0": "cc0",
}

NOTICES = {
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions.""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software.""",
}
