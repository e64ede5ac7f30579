"""tunnelscan: covert-channel (DNS tunnelling) analytics on Spark DataFrames.

Modules are grouped by role:

* ``sources``   - readers and writers (CSV samples, nested DNS logs, models, config).
* ``functions`` - column expressions (the thirteen lexical features, label maps).
* ``operators`` - DataFrame -> DataFrame steps (domains, volume gate, verdict,
  alerts, model stages).
* ``plans``     - the end-to-end training and scoring jobs, fixtures, and the
  registered queries.
* ``streaming`` - the scoring job run on arriving hourly partitions.
"""

__version__ = "0.1.0"
