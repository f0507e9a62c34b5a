"""Column names and keys of the event tables."""

from __future__ import annotations

#: The key of an event in every table: its file, and its line within a section of that file.
EVENT = ["file_name", "event_idx"]

#: The 61 numbers of an event line, in order.
RAW_EVENT = """
mc_parttype mc_energy mc_theta mc_phi mc_core_x mc_core_y mc_core_z
yymmdd hhmmss nstclust nofwf usec
ldf_energy ldf_sc ldf_dsc ldf_chi2 ldf_ndof ldf_xcore ldf_dxcore ldf_ycore ldf_dycore ldf_s800
geom1_theta geom1_phi geom1_dtheta geom1_dphi geom1_chi2 geom1_ndof geom1_t0 geom1_dt0
bdist tdist
geom2_theta geom2_phi geom2_dtheta geom2_dphi geom2_chi2 geom2_ndof geom2_t0 geom2_dt0 geom_a geom_da
comb_energy comb_sc comb_dsc comb_chi2 comb_ndof comb_xcore comb_dxcore comb_ycore comb_dycore comb_s800
comb_theta comb_phi comb_dtheta comb_dphi
nhits nsclust nborder qtot_low qtot_up
""".split()

#: The 12 numbers of a hit, with their types.
RAW_HIT = {
    "xxyy": "int", "isgood": "int", "reltime_low": "double", "reltime_up": "double", "pulsa_low": "double", "pulsa_up": "double",
    "x": "double", "y": "double", "z": "double", "vem_low": "double", "vem_up": "double", "nfold": "int",
}

#: Time bins of a waveform layer, and numbers of a waveform record: id, two clocks, two layers.
BINS = 128
WAVEFORM_SIZE = 3 + 2 * BINS

#: Markers that open a section, in the order in which they are tested.
SECTIONS = {"EVENT DATA": "event", "SD meta DATA": "hit", "SD waveform DATA": "waveform", "badsdinfo": "bad"}
