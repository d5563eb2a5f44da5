import sys

from circulation.cli import main

sys.exit(main())
