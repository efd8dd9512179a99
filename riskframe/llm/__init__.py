"""Training-data operators (documents, pages, conversations, benchmark).

Nothing else in the library imports this subpackage.  ``registry`` holds the
registered queries; every operator module has its own general interface.
"""
