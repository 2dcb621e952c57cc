import sys

from tamis.cli import main

sys.exit(main())
