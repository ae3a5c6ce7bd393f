"""``python -m tracewright --key=value ...`` runs the streaming job."""

import sys

from tracewright.streaming.cli import main

sys.exit(main())
