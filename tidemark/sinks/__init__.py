"""Writers for files, brokers, databases and keyed stores."""
