from revlens.plans.jobs import main

main()
