"""Document-corpus extraction as Spark jobs.

A table of documents (or a stream of files) goes in; result, element and
error tables come out.  Sub-packages:

* ``functions`` - column expressions; no shuffle, no Python at run time
* ``operators`` - DataFrame in, DataFrame out
* ``sources``   - file, request and archive readers; result and error sinks
* ``plans``     - whole jobs composed from the operators
* ``streaming`` - Structured Streaming versions of the jobs
"""

from leafmill.limits import Limits

__all__ = ["Limits"]
__version__ = "0.1.0"
