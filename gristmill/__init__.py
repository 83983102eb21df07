"""Web-text corpus cleaning as Spark DataFrame operators.

``functions`` hold Column helpers, ``operators`` DataFrame-to-DataFrame rules,
``sources`` readers and writers, ``plans`` whole stages, ``streaming`` the
file-stream form of the first stage, and ``catalog`` the registered queries.
"""
