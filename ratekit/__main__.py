import sys

from ratekit.cli import main

sys.exit(main())
