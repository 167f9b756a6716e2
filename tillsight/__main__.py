"""``python -m tillsight <input> [output] [options]``: the batch job."""

import sys

from tillsight.job import main

sys.exit(main())
