import sys

from lakeload.cli import main

sys.exit(main())
