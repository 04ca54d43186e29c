from tidewatch.cli import main

main()
