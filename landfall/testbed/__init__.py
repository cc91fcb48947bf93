"""The generated test tables seen as arrival data, and the independent SQL the queries are compared with."""
