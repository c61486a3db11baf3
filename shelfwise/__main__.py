from shelfwise.cli import main

main()
