from wayfare.plans.cli import main

main()
