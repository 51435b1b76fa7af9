import sys

from ferret.cli import main

sys.exit(main())
