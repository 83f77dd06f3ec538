from quire.jobs import main

main()
