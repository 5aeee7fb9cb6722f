import sys

from tablewatch.cli import main

sys.exit(main())
