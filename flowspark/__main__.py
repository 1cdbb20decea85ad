from flowspark.cli import main

main()
