"""License notices and texts, as published by their stewards; fixed texts."""

from lodeplane.llm.license_bodies import BODIES

_SHORT: tuple[tuple[str, str], ...] = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "bsd-3-clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "lgpl-2.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "lgpl-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "agpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc-by-nd-4.0", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "Licensed under CC0 1.0 Universal."),
    ("mpl-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("epl-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("isc", "Licensed under the ISC License."),
    ("bsd-2-clause", "Licensed under the BSD 2-Clause License."),
    ("bsd-3-clause", "Licensed under the BSD 3-Clause License."),
)

#: As in SPDX identifiers; `-only` and `-or-later` may follow.
_SPDX = (
    "mit apache-2.0 isc unlicense 0bsd bsd-2-clause bsd-3-clause mpl-1.1 mpl-2.0 epl-1.0 epl-2.0 cc0-1.0 artistic-1.0 artistic-2.0 gpl-1.0 gpl-2.0 gpl-3.0 lgpl-2.0 lgpl-2.1 "
    "lgpl-3.0 agpl-3.0 gfdl-1.2 gfdl-1.3 cc-by-4.0 cc-by-sa-4.0 cc-by-nd-4.0 cc-by-nc-4.0 cc-by-nc-sa-4.0 cc-by-nc-nd-4.0"
).split()

NOTICES: tuple[tuple[str, str], ...] = (*_SHORT, *((name, f"SPDX-License-Identifier: {name}") for name in _SPDX), *BODIES)
