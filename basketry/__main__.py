from basketry.cli import main

raise SystemExit(main())
